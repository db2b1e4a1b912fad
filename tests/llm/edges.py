"""Documents with every edge case, and plain versions of what operators compute."""

import re

from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PROSE = (
    "the harbour lay still under a thin grey mist while two boats moved slowly past the old "
    "lighthouse and nobody on the pier said a word about the storm of the night before"
)
#: Columns whose names the operators use for their own results.
SCHEMA = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("text", StringType()),
        StructField("lang", StringType()),
        StructField("source", StringType()),
        StructField("n_chars", LongType()),
        StructField("score", DoubleType()),
        StructField("n_words", StringType()),
        StructField("root", LongType()),
        StructField("K1", StringType()),
        StructField("found", LongType()),
        StructField("n", LongType()),
    ]
)
LONG = " ".join(f"{PROSE} and then {PROSE} number {i}" for i in range(1500))
TEXTS = [
    (1, PROSE),
    (2, PROSE),
    (3, PROSE + " indeed"),
    (4, None),
    (5, ""),
    (6, " \t\n \r\n"),
    (7, "two words"),
    (8, "two words"),
    (None, PROSE + " once more, without an id"),
    (9, LONG),
    (10, "été ñandú 日本語 текст 𝄞 𝄞 \u00a0 end"),
    (11, "x" * 5000),
    (12, "a b c d e\n" * 40),
    (12, "a b c d e\n" * 40),
    (13, "### *** %%% $$$ &&& ||| <<< >>> one two three four five"),
]


def edge_documents(spark, texts=TEXTS):
    rows = [(i, t, None, "s", None if t is None else len(t), 0.5, "w", 1, "k", 2, 3) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


def shingles(text, k=5):
    words = WORD.findall(text or "")
    k = min(k, len(words))
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if words else frozenset()


def groups(sets, threshold=0.8):
    """Links per set and the first member of its group, by comparing all pairs."""
    parent = list(range(len(sets)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = [0] * len(sets)
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and len(a & b) >= threshold * len(a | b):
                links[i] += 1
                links[j] += 1
                x, y = top(i), top(j)
                parent[max(x, y)] = min(x, y)
    return links, [top(i) for i in range(len(sets))]
