"""Operators for preparing training text. Nothing else in the library imports
this subpackage; its queries are in :mod:`.queries`, their SQL in :mod:`.oracle`."""
