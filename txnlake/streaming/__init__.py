"""Change-stream decoding, stream features and stateful operators."""
