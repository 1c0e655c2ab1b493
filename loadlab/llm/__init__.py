"""Operators for preparing training data at scale (see README, "Training-data operators").

Nothing else in the library imports this package.  Each module holds one operator
with a general interface; ``queries`` derives the registered ``opN_*`` results from them.
"""
