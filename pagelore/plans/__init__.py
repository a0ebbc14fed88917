"""End-to-end jobs: readers, operators and writers put together."""
