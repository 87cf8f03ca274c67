"""Where the tests find their tables."""

FOLDER = "/root/testdata/sf0.001"
