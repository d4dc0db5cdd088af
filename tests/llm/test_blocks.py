"""Frequent shingles: no task of the last listing meets more than two blocks, and no pair is lost."""
import random

import numpy as np
from pyspark.sql import functions as F

from fareforge.llm import jaccard


def test_blocks_are_bounded_and_whole(spark):
    rng = random.Random(3)
    rows = [(7, rng.choice([4, 5]), rng.random() < 0.7, i, rng.randint(40, 60), rng.randint(0, 9), 0 if i < 150 else 1 + i % 20)
            for i in range(400)] + [(8, 4, True, i, 50, 1, 3) for i in range(50)]
    df = spark.createDataFrame(rows, "token long, band int, own boolean, node long, n int, pos int, component long")
    want = {(min(x[3], y[3]), max(x[3], y[3])) for x in rows for y in rows if x[:2] == y[:2] and x[6] != y[6] and (x[2] or y[2])
            and jaccard.may_link(*map(np.array, (x[4], x[5], y[4], y[5])))}
    met = jaccard.dealt(df, None, 16).withColumn("bits", F.lit(bytes(32)))  # bitmaps that rule nothing out
    keys = ["token", "band", "a", "b"]
    assert met.groupBy(*keys).count().agg(F.max("count")).first()[0] <= 80
    got = jaccard.across(met.repartition(*keys).sortWithinPartitions(*keys, "n", "node"), None).collect()
    assert {(r.u, r.v) for r in got} == want
    alone = jaccard.dealt(df, 2, 16)
    assert alone.count() == 400 and alone.groupBy(*keys).count().agg(F.max("count")).first()[0] <= 40


def test_a_tokenizer_that_cuts_otherwise_is_given_whole_texts(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    from fareforge.llm import token_store
    texts = ["Mixed Case  text, it's 12 o'clock", "", "Ünï straße\n\tend", "<|endoftext|> x"]
    for name, by_words in (("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)):
        path = public_tokenizers.path(name)
        encoder = token_store.Encoder(path)
        assert encoder.by_words == by_words
        plain = Tokenizer.from_file(path)
        want = [plain.encode(t, add_special_tokens=False).ids + [token_store.END_ID] for t in texts]
        assert [np.frombuffer(x, encoder.kind).tolist() for x in encoder.ids(texts)] == want
