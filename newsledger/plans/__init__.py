"""End-to-end runs and the registered queries over the test tables."""
