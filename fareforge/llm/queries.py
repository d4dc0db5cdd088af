"""One query per operator over its whole table, with the SQL it must agree with where SQL can say it."""
from . import (alignment, decontaminate, extract, host_rules, jaccard, language, license, mixing, negatives, packing, quality,
               token_store, warc)
from .common import table

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn
    return register


@query("""
WITH sized AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents),
total AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY 1),
turn AS (SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight FROM total),
room AS (SELECT *, 3 * source_size / weight AS room FROM turn),
lev AS (SELECT *, ((SELECT sum(source_size) FROM room) - 3 * coalesce(sum(source_size) OVER (ORDER BY room, source NULLS LAST
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
  / sum(weight) OVER (ORDER BY room, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM room),
target AS (SELECT source, source_size, CASE WHEN source_size > 0 THEN
    least(3.0 * source_size, weight * (SELECT max(level) FROM lev WHERE level <= room))::DOUBLE ELSE 0.0::DOUBLE END AS target FROM lev),
queued AS (SELECT doc_id, s.source, size, md5('mix:' || doc_id || ':' || size) AS k FROM sized s),
sent AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY k, doc_id ROWS UNBOUNDED PRECEDING) AS upto FROM queued WHERE size > 0),
finish AS (SELECT s.*, p, (p * source_size + upto)::DOUBLE / target AS fin FROM sent s
  JOIN target t ON s.source IS NOT DISTINCT FROM t.source, range(3) AS passes(p)),
cut AS (SELECT *, sum(size) OVER (ORDER BY fin, k, doc_id, p ROWS UNBOUNDED PRECEDING) AS done FROM finish),
took AS (SELECT doc_id, sum(size)::BIGINT AS taken FROM cut WHERE done <= (SELECT sum(size) FROM sized) GROUP BY 1)
SELECT s.doc_id, s.size, t.source_size, t.target, coalesce(k.taken, 0)::BIGINT AS taken FROM sized s
JOIN target t ON s.source IS NOT DISTINCT FROM t.source LEFT JOIN took k ON k.doc_id = s.doc_id
""")
def op2_mix(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


def _rates_sql() -> str:
    return ", ".join(f"avg(f_{r} / n) AS m_{r}, var_samp(f_{r} / n) AS v_{r}" for r in host_rules.SOFT)


def _shrunk_sql(r: str) -> str:
    k = f"(CASE WHEN coalesce(v_{r}, 0) > 0 THEN least(greatest(m_{r} * (1 - m_{r}) / v_{r} - 1, 1.0), 1e6) ELSE 1e6 END)"
    return f"((f_{r} + m_{r} * {k}) / (n + {k})) AS rate_{r}"


_SHARES = {"symbols": "n_symbols / greatest(n_words, 1)", "dup_lines": "n_dup_lines / greatest(n_lines, 1)",
           "repeats": "n_repeat_words / greatest(n_words, 1)"}
_BAD = " OR ".join(f"({_SHARES[r]} > {hard} OR ({_SHARES[r]} > {soft} AND rate_{r} > {host_rules.HOST_RATE}))"
                   for r, (soft, hard) in host_rules.SOFT.items())


@query(f"""
WITH w AS (SELECT doc_id, source, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM documents),
gram AS (SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
twice AS (SELECT doc_id, i FROM gram QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (SELECT doc_id, count(*)::BIGINT AS n FROM (SELECT DISTINCT doc_id, i + d AS j FROM twice, range(3) AS t(d)) GROUP BY 1),
stats AS (SELECT w.doc_id, source, len(words)::BIGINT AS n_words, length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines
  FROM w LEFT JOIN covered ON covered.doc_id = w.doc_id),
hosts AS (SELECT source, count(*) AS n, {", ".join(f"count(*) FILTER (WHERE {e} > {host_rules.SOFT[r][0]}) AS f_{r}" for r, e in _SHARES.items())}
  FROM stats GROUP BY 1),
prior AS (SELECT {_rates_sql()} FROM hosts),
rates AS (SELECT source, {", ".join(map(_shrunk_sql, host_rules.SOFT))} FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT ({_BAD}) AS kept
FROM stats LEFT JOIN rates ON stats.source IS NOT DISTINCT FROM rates.source
""")
def op3_host_rules(spark, sf_dir):
    judged = host_rules.judge(table(spark, sf_dir, "documents"))
    return judged.drop(*[f"rate_{r}" for r in host_rules.SOFT])


@query(license.scan_sql())
def op6_license_scan(spark, sf_dir):
    return license.scan(table(spark, sf_dir, "documents"))


@query()
def op7_token_store(spark, sf_dir):
    import public_tokenizers
    return token_store.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query()
def op4_quality(spark, sf_dir):
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op8_language(spark, sf_dir):
    return language.identify(table(spark, sf_dir, "documents"))


@query()
def op1_warc(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages"))


@query()
def op9_extract(spark, sf_dir):
    return extract.extract(table(spark, sf_dir, "pages"))


@query()
def op5_decontaminate(spark, sf_dir):
    return decontaminate.check(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op10_jaccard(spark, sf_dir):
    return jaccard.join(table(spark, sf_dir, "documents"))


@query()
def op11_alignment(spark, sf_dir):
    import public_tokenizers
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.align(table(spark, sf_dir, "documents"), *paths)


@query(negatives.mine_sql())
def op12_negatives(spark, sf_dir):
    return negatives.mine(table(spark, sf_dir, "embeddings"))


@query()
def op13_packing(spark, sf_dir):
    import public_tokenizers
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)
