"""Small tables of documents for the tests of the document operators."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key long, bits long, `a.b` string, words string"


def prose(rng, n, letters="abcdefgh"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 7))) for _ in range(n))


def table(spark, rows):
    """Documents (id, text[, lang]) with further columns whose names the operators use themselves."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src", len(r[1] or ""), 1, 2, "x", "y") for r in rows]
    return spark.createDataFrame(full, SCHEMA)
