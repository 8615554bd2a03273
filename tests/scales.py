"""Folders of the given tables, under a module name of its own: ``conftest`` is taken by whichever folder is collected last."""

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"
