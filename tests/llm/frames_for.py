"""Small document frames with every awkward case, and plain versions of the rules."""

from __future__ import annotations

import random
import re

import pyarrow as pa

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def documents(spark, rows, extra=()):
    """(doc_id, text) rows as documents; ``extra`` names more columns, which hold nines."""
    ids, texts = [r[0] for r in rows], [r[1] for r in rows]
    n = len(rows)
    columns = {"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.string()),
               "lang": pa.array(["en"] * n, pa.string()),
               "source": pa.array([r[2] if len(r) > 2 else "s" for r in rows], pa.string()),
               "n_chars": pa.array([len(t or "") for t in texts], pa.int64())}
    for name in extra:
        columns[name] = pa.array([9] * n, pa.int64())
    return spark.createDataFrame(pa.table(columns))


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    parts = "an the of in er on ti re ed ou ha wh ble sh ing".split()
    words = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(n)]
    return "".join(w + ("\n" if rng.random() < 0.05 else " ") for w in words)


def edited(text: str, seed: int, share: float) -> str:
    rng = random.Random(seed)
    return " ".join(f"x{rng.randrange(10**6)}" if rng.random() < share else w for w in text.split(" "))


AWKWARD = [(None, "no id at all but a long enough line here"), (90, None), (91, ""), (92, " \t\n "),
           (93, "one"), (94, "two words"), (95, "Ünïcödé ÀÉÎ 漢字 \x00 nul\r\nand more"), (96, "\n\n")]


def rows_of(df):
    return [r.asDict() for r in df.collect()]
