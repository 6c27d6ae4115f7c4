"""Training-data operators: packing, tokenising, classifiers, PII, archives, joins, search.

Nothing else in the library imports this subpackage.  Each module holds one
operator with its own general interface; ``queries`` registers the thin
``opN_*`` queries over the driver's tables.
"""
