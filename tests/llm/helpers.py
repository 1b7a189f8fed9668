"""Fixture documents: nulls, empty and very long texts, ties, repeated rows, clashing column names."""

from __future__ import annotations

import random

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# The same with columns named like the operators' own.
CLASH_SCHEMA = DOC_SCHEMA + ", n int, h string, fp string, chunk string, size int, u string, key string, component_id int, rep int"


def words(rng: random.Random, n: int) -> str:
    syllables = ["ka", "lo", "mi", "the", "ren", "Tu", "vos", "é", "ßa", "nor"]
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(n))


def documents(seed: int = 1) -> list[tuple]:
    rng = random.Random(seed)
    base = [words(rng, rng.randint(60, 160)) for _ in range(12)]
    passage = words(rng, 30)
    rows = [(i, t, "en", "src%d" % (i % 4), len(t)) for i, t in enumerate(base)]
    rows.append((20, base[0], "en", "src0", None))  # an exact copy
    w = base[1].split(" ")
    rows.append((21, " ".join(["XX", *w[1:]]), None, None, 1))  # a near copy
    rows.append((22, base[2] + "\n" + passage + " end", "de", "src1", 2))
    rows.append((23, passage + "\n" + base[3][:80], "de", "src2", 2))
    rows += [(30, None, "en", "src1", None), (31, "", "en", "src1", 0), (32, " \t\n", None, "src1", 3), (33, "one two", "en", "src3", 7)]
    rows += [(40, base[4], "en", "src0", 1), (40, base[4], "en", "src0", 1)]  # repeated rows, also a copy of 4
    rows.append((None, base[5], "en", "src2", 1))  # no id
    rows.append((50, " ".join([base[6]] * 40) + " " + words(rng, 3000), "en", "src0", 1))  # long, repeats itself
    rows.append((51, "a\x00b \x1f c　d <|endoftext|> it's 12", "en", "src0", 1))
    return rows


def frame(spark, rows=None, clash=False):
    rows = documents() if rows is None else rows
    if clash:
        return spark.createDataFrame([(*r, 1, "x", "y", "z", 2, "u", "k", 3, 4) for r in rows], CLASH_SCHEMA)
    return spark.createDataFrame(rows, DOC_SCHEMA)


def ascii_lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
