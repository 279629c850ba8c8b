"""A small corpus with copies, near copies, shared passages and odd cases, and plain words of a text."""

import random
import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def documents(n=60, seed=3):
    """(doc_id, text) pairs: plain texts, exact and near copies, a passage that several share, and odd ones."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéßñ") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    out = []
    for i in range(n):
        kind = i % 6
        text = " ".join(rng.choice(vocabulary) for _ in range(rng.randint(30, 120)))
        if kind == 1:
            text = out[i - 1][1]
        elif kind == 2:
            parts = out[i - 2][1].split()
            parts[len(parts) // 2] = "changed"
            text = " ".join(parts)
        elif kind == 3:
            text = f"{text[:50]} {passage} {text[50:]}"
        out.append((i, text))
    odd = ["", None, "one", "Two Words", "  \n\t ", "É é \U0001F600 x" * 3, "a " * 3000, "z" * 5000, "a " * 3000, "Two words"]
    return out + [(n + i, t) for i, t in enumerate(odd)]


def table(spark, rows):
    """The rows as a ``documents`` table, with columns whose names operators use as well."""
    full = [(i, t, "en", f"s{(i or 0) % 4}" if i is None or i % 9 else None, len(t or "")) for i, t in rows]
    df = spark.createDataFrame(full, SCHEMA)
    clash = ["score", "key", "node", "label", "spans", "runs", "kept", "n", "bands", "anchor", "places", "block", "row", "taken", "size", "target", "n_tokens", "n_words"]
    for c in clash:
        df = df.selectExpr("*", f"'x' as {c}")
    return df.repartition(3)
