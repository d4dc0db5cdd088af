"""Whole license texts as templates."""
import random

from fareforge.llm import license


def test_long_templates(spark):
    rng = random.Random(1)
    pool = [f"{a}{b}" for a in ("lic", "grant", "term", "right", "copy") for b in ("ense", "ed", "s", "ing", "able", "or")]
    words = [rng.choice(pool) for _ in range(300)]
    long = " ".join(words)
    changed = list(words)
    for k in rng.sample(range(300), 15):
        changed[k] = "other"
    rows = [(1, f"Before. {long.upper()}, after"), (2, " ".join(changed)), (3, " ".join(words[:100])), (4, "plain words only"),
            (5, " ".join(words[:65])), (6, " ".join(words[200:])), (7, "all rights reserved"), (8, None)]
    got = {r.doc_id: r for r in license.scan(spark.createDataFrame(rows, "doc_id long, text string"), {"long-1.0": long}).collect()}
    assert got[1].labels == "long-1.0" and got[1].score == 1.0
    assert got[2].labels == "long-1.0" and 0.8 < got[2].score < 1
    assert all(got[k].labels == "" for k in (3, 4, 5, 6, 8)) and got[7].labels == "reserved"
