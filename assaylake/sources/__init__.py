"""Files the lake reads and writes. Every path may be any Hadoop URI."""
