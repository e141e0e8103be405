"""Where the tests find the generated tables."""

DATA = "/root/testdata/sf0.001"
