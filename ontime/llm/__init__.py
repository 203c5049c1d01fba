"""Training-data operators: chat formatting, search, classifiers, tokenisation, dedup, packing.

Nothing else in the library imports this subpackage. Each module holds one operator with its
own general interface; ``queries`` has the registered ``opN_<name>`` queries and their SQL.
"""
