"""Folder of the smallest tables, for the tests of both folders."""

FOLDER = "/root/testdata/sf0.001"
