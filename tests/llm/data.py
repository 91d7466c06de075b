"""Small documents that hold every edge case the operators must define."""
import random
import re

from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

# extra columns whose names the operators could use themselves
DOCS = T.StructType([T.StructField(n, t) for n, t in (
    ("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()),
    ("n_chars", T.LongType()), ("row", T.StringType()), ("node", T.LongType()), ("_row", T.StringType()),
    ("log_weight", T.DoubleType()), ("matches", T.StringType()), ("key", T.IntegerType()))])


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def shingles(text):
    w = words(text)
    return set(zip(*(w[i:] for i in range(5)))) if len(w) >= 5 else ({tuple(w)} if w else set())


def doc(i, text, source="s1", lang="en"):
    return (i, text, lang, source, None if text is None else len(text), "x", 1, "y", 0.5, "m", 3)


def prose(seed, n, vocabulary=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


def edited(text, seed, share):
    r = random.Random(seed)
    return " ".join(x if r.random() >= share else f"e{seed}x{r.randrange(10**6)}" for x in text.split(" "))


def edge_docs():
    """Nulls, empty and white texts, few words, ties, repeated rows, copies, near copies, a
    very long text and a word longer than the hashing pieces."""
    base = prose(1, 300)
    out = [doc(1, None), doc(2, ""), doc(3, " \t\n "), doc(4, "one two"), doc(5, "ONE two"), doc(6, "one"),
           doc(None, base), doc(7, base), doc(7, base), doc(8, base.upper()), doc(9, base + " more", None),
           doc(10, None, None), doc(None, None, None), doc(11, "x" * 1_500_000), doc(12, prose(2, 60_000, 50_000)),
           doc(13, prose(2, 60_000, 50_000) + " tail")]
    out += [doc(100 + i, edited(base, i, 0.02), f"s{i % 3}") for i in range(60)]  # near copies, hub and chains
    out += [doc(200 + i, edited(base, i + 500, 0.05), "s2") for i in range(30)]
    out += [doc(300 + i, prose(1000 + i, 5 + 7 * (i % 30)), f"s{i % 4}") for i in range(80)]
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, DOCS)
