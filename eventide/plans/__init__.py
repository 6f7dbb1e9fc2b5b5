"""Registered queries over the driver tables (``catalog``) and the mapping of
the behaviour jobs' record types onto those tables (``domain``)."""
