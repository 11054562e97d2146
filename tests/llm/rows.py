"""Rows and names that the tests of the text operators share."""
import random

from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"
SYLLABLES = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "ó", "ß", "ñe"]


def prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n))


def awkward_rows() -> list[tuple]:
    """Null ids and texts, empty and long texts, ties, repeated rows, odd characters."""
    rng = random.Random(5)
    base = prose(rng, 120)
    return [
        (1, base), (2, base), (3, "".join(c.upper() if "a" <= c <= "z" else c for c in base)), (4, base + " end"), (4, base + " end"), (5, None), (6, ""), (7, None),
        (None, base), (None, "no id"), (8, "x"), (9, "\x00\x01 \n\t"), (10, "<|endoftext|> </turn> ### \\ %3A"),
        (11, prose(rng, 30000)), (12, "ab " * 20000), (13, " " * 70000 + "end"), (14, "a" * 300000),
        (15, "🙂 ñandú İ K ﬀ 中文 １２３"), (16, "  lead and trail  "), (17, base[:200]), (18, prose(rng, 13)), (19, prose(rng, 12)),
    ]


# names that the operators use themselves
CLASHING = ["id", "row", "fp", "key", "h", "sha", "norm", "score", "text_hash", "hits", "items", "x", "spans", "y", "label",
            "component_id", "keep_id", "block", "host", "kept", "copies", "n_words", "start", "length", "fold"]


def with_clashes(df):
    return df.withColumns({c: F.lit(f"own {c}") for c in CLASHING})
