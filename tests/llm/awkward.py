"""Awkward rows (doc_id, text), and columns named like results or inner columns of the operators."""

CLASHING = {"score": 1.0, "size": 2, "fp": "x", "root": 3, "found": "y", "shard": 4, "ids": "z", "scan": 5, "point": 6, "key": 7}
AWKWARD = [(None, "a text without an id here"), (None, None), (7, None), (8, ""), (9, " \n\t "), (10, "ü"), (10, "ü"),
           (11, "퟿ \U0001f600 ."), (12, "word " * 40_000)]
