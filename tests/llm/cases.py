"""Rows that every operator has to cope with."""

from __future__ import annotations

import random

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 6))) for _ in range(n))


def odd_rows(seed: int = 1) -> list[tuple]:
    """Copies, near copies, empty, blank, null and long texts, repeated rows, null ids and sources."""
    rng = random.Random(seed)
    base = [words(rng, rng.randint(1, 60)) for _ in range(25)]
    texts: list[str | None] = list(base)
    texts += [base[i % 5] for i in range(20)]
    texts += [base[3].replace(" ", "  ", 2), base[3] + " \n", "\t" + base[4]]
    texts += [base[i] + " extra" for i in range(5)]
    texts += [None, "", " ", "\n\t ", "x", "same " * 300, words(rng, 4000), "line one\nline two\nline three\nline four"] * 2
    texts += ["Ünï – 漢字 😀 \x01 <|endoftext|> isn't 12", "no-white-space" * 200]
    rows = [(i * 3, x, "en", f"src{i % 3}" if i % 7 else None, len(x or "")) for i, x in enumerate(texts)]
    return [*rows, rows[0], rows[0], (None, base[0], "en", "src1", len(base[0])), (None, None, None, None, None)]


def odd_docs(spark, seed: int = 1, partitions: int = 4):
    return spark.createDataFrame(odd_rows(seed), DOC_SCHEMA).repartition(partitions)


def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


CLASHING = ("size", "key", "n", "fp", "norm", "cell", "bucket", "page", "score", "target", "_key", "_range", "later", "runs", "kept", "sha", "_sha", "_copy", "_part")


def with_clashes(df):
    """The rows with more columns, named like those that operators add or work with."""
    return df.selectExpr("*", *(f"'x' AS {name}" for name in CLASHING if name not in df.columns))


def found(df) -> list[tuple]:
    return sorted((tuple(row) for row in df.collect()), key=repr)
