"""Small awkward tables: nulls, empty and long texts, ties, repeated rows, clashing extra columns."""

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(seed: int, n: int) -> str:
    """Invented words in a fixed order."""
    out, x = [], seed * 7919 + 1
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[x % 24] + str(x // 24 % 97))
    return " ".join(out)


LONG = prose(99, 30_000)
ROWS = [
    (1, prose(1, 80)), (2, prose(2, 60)), (2, prose(2, 60)), (3, None), (4, ""), (None, prose(3, 50)), (None, None), (5, "é"),
    (6, prose(1, 80) + " tail"), (7, prose(1, 79) + " end"), (8, LONG), (9, " \n\t "), (10, "one two"), (2, prose(4, 30)), (11, prose(1, 80)),
    (12, "Ünïcödé 😀 " * 30), (13, "x" * 5000), (14, prose(5, 40) + " " + prose(1, 40)),
]
EXTRAS = ("key", "fp", "bin", "score", "pos", "term", "row", "spans", "label", "start", "length", "offset", "root", "base",
          "_key", "_hit", "_row", "_text", "_node", "_alias", "_cuts", "_to", "_by", "n_hit", "cuts", "body", "node", "alias", "line", "top", "gone", "hit_id",
          "parts", "n", "tf", "terms", "impacts", "slice", "rank", "number", "runs", "kept", "collapsed", "key_", "row_", "body_")


def documents(spark, rows=ROWS):
    """The rows with many extra columns that operators use as names inside."""
    filled = [(i, t, None, "src" if k % 2 else None, None if t is None else len(t), *([k] * len(EXTRAS))) for k, (i, t) in enumerate(rows)]
    columns = ", ".join(f"{c} int" for c in EXTRAS)
    return spark.createDataFrame(filled, f"doc_id long, text string, lang string, source string, n_chars long, {columns}").repartition(3)
