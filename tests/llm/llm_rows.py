"""Rows that the tests of this folder share."""

SF = "/root/testdata/sf0.01"
#: Names that operators use for columns of their own.
CLASH = ("row", "doc", "size", "target", "copies", "shards", "n_lines", "n_dropped", "lang_pred", "score", "ids", "starts",
         "spans", "kept", "hash", "high", "low", "n_tokens", "removed", "place", "block", "found", "id", "bands", "windows")

LONG = "Der lange Satz hat viele Worte und endet hier. " * 4000
EDGES = [
    (1, None, None, None),
    (2, "", "en", "a"),
    (3, " \n\t ", "en", None),
    (4, "1234 5678", None, "a"),
    (5, "A plain line that is long enough to count.\nshort", "en", "a"),
    (5, "A plain line that is long enough to count.\nshort", "en", "a"),
    (6, "a PLAIN line that is long enough to count.  \nother words here", "en", "b"),
    (7, "\tA plain line that is long enough to count.\nétrange ligne avec des accents, très étrange", "fr", "b"),
    (8, LONG, "de", "b"),
    (None, "A plain line that is long enough to count.\nno id here", None, None),
    (None, None, None, None),
]
