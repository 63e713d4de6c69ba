"""Small tables that every corpus operator must survive."""

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, kept string, shard string, size string, "
          "fingerprint string, digest string, slot string, id string, _row string, target double, _language string, _digest string, "
          "_again string, _same string, _hash string, _known string, _id string, _sha string, _place string, _shard string, "
          "_order string, found string, again string, known string, number string, sha string, same string, turn string, "
          "row_id string, row_hash string, row_count string, place string, `order` string, copy_id string, copy_hash string, "
          "copy_places string, row string, head string, pairs string, hash string, tie string, packed string, ranges string")
LONG = "lorem ipsum dolor " * 20_000


def table(spark, rows):
    """Rows are (doc_id, text, lang, source); columns with clashing names are added."""
    return spark.createDataFrame([(*r, len(r[1] or ""), *["x"] * 8, 1.0, *["y"] * 33) for r in rows], SCHEMA)


def awkward(spark):
    return table(spark, [
        (1, "One two three four five six", "en", "a"),
        (2, "one TWO three four five six", "en", None),
        (2, "one TWO three four five six", "en", None),
        (3, None, None, None),
        (4, "", "de", "b"),
        (5, " \t\n", "de", "b"),
        (None, "One two three four five six", None, "a"),
        (None, None, "fr", "b"),
        (6, LONG, "en", "c"),
        (7, "É ß İ ſ 日本語 💩 \u0000 é", "fr", "c"),
        (8, "é", None, "c"),
        (-9, "one two three four five seven", "en", "a"),
        (1 << 62, "x", "en", "a"),
    ])


def empty(spark):
    return table(spark, [])
