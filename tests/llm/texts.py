"""Small tables and plain Python versions of the operators' results."""

from __future__ import annotations

import hashlib
import random
import re

WORD = re.compile("[^\x20\x09-\x0d]+")


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema).repartition(3)


def passages(seed: int, n: int = 200) -> list[tuple]:
    """Documents made of shared passages, noise, repeated words, blanks and nulls; some ids repeat or are null."""
    rng = random.Random(seed)
    pool = [" ".join(rng.choice("abcdefghij") + rng.choice("klmno") for _ in range(rng.randint(3, 80))) for _ in range(20)]
    rows = []
    for i in range(n):
        parts = [
            rng.choice(pool) if rng.random() < 0.6 else " ".join(rng.choice("xyz") for _ in range(rng.randint(1, 90)))
            for _ in range(rng.randint(0, 5))
        ]
        if rng.random() < 0.1:
            parts = ["word"] * rng.randint(0, 300)
        text = rng.choice(["\n", " ", "\t "]).join(parts) if rng.random() < 0.95 else None
        rows.append((rng.choice([i, i, i, i, None, i // 2]), text))
    return rows


def table(spark, tmp_path, rows, schema="doc_id long, text string", name="documents") -> str:
    """A folder with one table, as the registered queries read it."""
    spark.createDataFrame(rows, schema).repartition(2).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)
