"""Names shared by the tests of the core library."""

SF_SMALL = "/root/testdata/sf0.001"
