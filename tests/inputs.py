"""Where the given tables are."""

TINY = "/root/testdata/sf0.001"
