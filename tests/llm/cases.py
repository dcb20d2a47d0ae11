"""Documents with everything that may be odd about them."""

from __future__ import annotations

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "size string, row int, key string, piece int, label string, bucket int, n bigint"
)
LONG = " ".join(f"word{i % 5003} and{i % 977}" for i in range(60_000))
PROSE = (
    "the quick brown fox jumps over the lazy dog while seven other animals watch from "
    "the far side of a small river and wonder what all of this could ever mean"
)
TEXTS = [
    (0, PROSE, "en", "a"),
    (1, PROSE, "en", "a"),
    (2, PROSE + " now", "en", "b"),
    (2, PROSE + " now", "en", "b"),
    (3, None, "en", "a"),
    (4, "", None, None),
    (5, " \n\t ", "en", None),
    (6, "one", None, "b"),
    (7, LONG, "en", "a"),
    (8, "1234 %% 5678", "fr", ""),
    (None, "a document without any number of its own", None, "a"),
    (None, None, None, None),
    (9, "héé ñandú ß <|endoftext|> İstanbul 中文 don't x'", "es", "é"),
    (10, "first line here\nfirst line here\n\nlast line", "en", "a"),
]


def documents(spark, rows=TEXTS):
    """The rows with further columns whose names the operators use themselves."""
    more = [
        (d, t, lang, source, None if t is None else len(t), "s", i, "k", 7, "x", 3, None)
        for i, (d, t, lang, source) in enumerate(rows)
    ]
    return spark.createDataFrame(more, SCHEMA)


def labels(spark, rows=((0, 1), (2, 1), (3, 0), (5, 0), (8, 0), (7, 1), (None, 1), (4, None))):
    return spark.createDataFrame([(d, q, 0) for d, q in rows], "doc_id bigint, quality int, toxic int")


def words(text):
    return (text or "").encode().split()


def shingles(text):
    own = words(text)
    if len(own) < 5:
        return {tuple(own)} if own else set()
    return {tuple(own[i : i + 5]) for i in range(len(own) - 4)}


def near_free(sets):
    """Whether no two different sets have a Jaccard similarity of 0.8."""
    places = {}
    for i, own in enumerate(sets):
        for shingle in own:
            places.setdefault(shingle, []).append(i)
    for i, own in enumerate(sets):
        shared = {}
        for shingle in own:
            for j in places[shingle]:
                if j < i:
                    shared[j] = shared.get(j, 0) + 1
        if any(10 * n >= 8 * (len(own) + len(sets[j]) - n) for j, n in shared.items()):
            return False
    return True
