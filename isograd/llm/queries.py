"""Registered queries of the training-text operators, and their SQL twins.

Each query applies its operator, with production parameters, to its whole
table and derives the result columns from the operator's output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isograd.llm import decontaminate as dc
from isograd.llm import fingerprints as fp
from isograd.llm import language as lg
from isograd.llm import licences as lc
from isograd.llm import lines as ln
from isograd.llm import lm
from isograd.llm import minhash as mh
from isograd.llm import packing as pk
from isograd.llm import quality as ql
from isograd.llm import runs as rn
from isograd.llm import suffix as sx
from isograd.llm import trie as tr
from isograd.llm import urls as ur

#: Rules for URLs by host and path.
URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ql.quality(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "quality.*")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    columns = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    return dc.decontaminate(docs.select("doc_id", "text"), items).select("doc_id", *[f"overlap.{c}" for c in columns])


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = F.coalesce(lg.held_out(F.col("doc_id")), F.lit(False))
    samples = lg.sample(docs.where(~out), "doc_id", "text", "lang")
    judged = lg.identify(docs.select("doc_id", "text"), samples)
    return judged.select(
        "doc_id", out.alias("held_out"), F.col("language.lang").alias("lang_pred"), "language.score", "language.bits_per_byte"
    )


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sx.dedup_substrings(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "dedup.n_bytes", "dedup.n_removed", "dedup.n_spans", F.sha2("dedup.kept", 256).alias("kept_sha256"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ln.dedup_units(table(spark, sf_dir, "documents").select("doc_id", "text"))
    taken = F.aggregate("dedup.removed", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])
    kept = F.coalesce(F.col("dedup.kept_text"), F.lit(""))
    return found.select(
        "doc_id", "dedup.n_units", "dedup.n_removed", taken.alias("removed_bytes"), F.sha2(kept, 256).alias("kept_sha256")
    )


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pk.pack(docs, tokenizer_path("byte_bpe_50k.json"))
    return found.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return ur.filter_urls(pages, URL_RULES, ur.train(ur.labelled(spark))).select("page_id", "judged.*")


def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = lc.scan_licences(docs, lc.background(docs))
    best = F.array_max(F.transform("licences.notices", lambda n: n["probability"]))
    return found.select(
        "doc_id", "licences.n_paragraphs", "licences.n_notices", F.array_join("licences.families", ",").alias("families"),
        F.coalesce(best, F.lit(0.0)).alias("probability"), F.array_join("licences.restrictions", ",").alias("restrictions"),
    )


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mh.classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lm.score(docs, lm.held_out(F.col("doc_id")))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fp.compare_neighbours(table(spark, sf_dir, "documents").select("doc_id", "text"))


def crc(column: str) -> Column:
    """Unsigned CRC-32 of a number in decimal."""
    return F.crc32(F.col(column).cast("string"))


def with_periods(docs: DataFrame) -> DataFrame:
    """Every text; of one in ten, by the id, the words from a chosen one on repeat with a chosen period."""
    h = F.coalesce(crc("doc_id"), F.lit(1))
    said = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g"), F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(rn.WORD), 0)).alias("w"))
    said = said.withColumn("n", F.size("w")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    said = said.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    source = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")
    again = F.array_join(F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.get("w", source(i))), " ")
    return said.select("doc_id", F.when(F.col("n") > 0, again).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rn.periodic_runs(with_periods(table(spark, sf_dir, "documents").select("doc_id", "text")))
    runs = F.col("periodic.runs")
    best = F.array_min(F.transform(runs, lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    lines = F.transform(runs, lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]))
    said = F.concat(F.array_join(lines, "\n"), F.when(F.size(runs) > 0, "\n").otherwise(""))
    held = found.select("doc_id", F.size(runs).cast("long").alias("n_runs"), best.alias("b"), said.alias("said"), "periodic.n_words", "periodic.collapsed")
    return held.select(
        "doc_id", "n_runs", F.col("b.s").alias("start"), (-F.col("b.l")).alias("length"), F.col("b.p").alias("period"),
        F.floor(-1000 * F.col("b.l") / F.col("b.p")).cast("long").alias("exponent_milli"),
        F.sha2("said", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words",
    )


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Numbered turns of conversations that begin like the first of their twenty, and all conversations."""
    parts = turns.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    sizes = parts.groupBy("conv_id").agg(F.sum("n").alias("n"))
    heads = sizes.select(F.col("conv_id").alias("base"), F.least("n", F.lit(3)).alias("n_base"))
    convs = sizes.select("conv_id", (F.col("conv_id") - F.col("conv_id") % 20).alias("base"), (crc("conv_id") % 4).alias("h"))
    asked = convs.join(heads, "base", "left").select("conv_id", "base", "h", F.least("h", F.coalesce("n_base", F.lit(0))).alias("taken"))
    first = turns.where((F.col("conv_id") % 20 == 0) & (F.col("pos") < 3)).select(F.col("conv_id").alias("base"), "pos", "id", "words")
    before = asked.join(first, "base").where(F.col("pos") < F.col("h")).select("conv_id", "pos", "id", "words")
    own = turns.join(parts.join(asked, "conv_id").select("conv_id", "part", "h", "taken"), ["conv_id", "part"])
    own = own.where(F.col("pos") >= F.col("h")).select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "id", "words")
    return before.unionAll(own), sizes.select("conv_id")


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = tr.numbered(tr.turn_ids(table(spark, sf_dir, "conversations")))
    return tr.prefix_trie(*rebuilt(turns))


def tokenizer_path(name: str) -> str:
    """Place of a vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


LLM_QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_language": op2_language,
    "op3_decontaminate": op3_decontaminate,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_line_dedup": op5_line_dedup,
    "op6_packing": op6_packing,
    "op7_url_filter": op7_url_filter,
    "op8_licences": op8_licences,
    "op9_minhash": op9_minhash,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_fingerprints": op11_fingerprints,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_conversation_trie": op13_conversation_trie,
}

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"



def _quality_sql() -> str:
    """Words numbered through their lines; characters under a window are those of words that it began at or shortly before."""
    lengths, whole = list(ql.NGRAM_LIMITS), "OVER (PARTITION BY doc ORDER BY i)"
    gram = lambda n: " || ' ' || ".join(["w"] + [f"lead(w, {j}) {whole}" for j in range(1, n)])
    under = lambda flag, n: f"max({flag}) OVER (PARTITION BY doc ORDER BY i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    share = lambda part, of: f"coalesce({part}, 0)::DOUBLE / greatest(coalesce({of}, 0), 1)"
    return rf"""
        WITH docs AS (SELECT row_number() OVER () AS doc, doc_id, coalesce(text, '') AS t FROM documents),
        line AS (
            SELECT *, row_number() OVER (PARTITION BY doc, l ORDER BY ln) > 1 AS again FROM (
                SELECT *, regexp_extract_all(l, '[^\x20\x09-\x0D]+') AS ws
                FROM (SELECT doc, unnest(string_split(t, chr(10))) AS l, generate_subscripts(string_split(t, chr(10)), 1) AS ln FROM docs)
            ) WHERE len(ws) > 0
        ),
        word AS (
            SELECT doc, again, w, length(w) AS chars, row_number() OVER (PARTITION BY doc ORDER BY ln, j) AS i
            FROM (SELECT doc, ln, again, unnest(ws) AS w, generate_subscripts(ws, 1) AS j FROM line)
        ),
        gram AS (SELECT *, {gram(3)} AS g3, {", ".join(f"{gram(n)} AS g{n}" for n in lengths)} FROM word),
        double AS (
            SELECT doc, i, chars, again, (g3 IS NOT NULL AND count(*) OVER (PARTITION BY doc, g3) > 1)::INT AS r3,
                {", ".join(f"(g{n} IS NOT NULL AND row_number() OVER (PARTITION BY doc, g{n} ORDER BY i) > 1)::INT AS r{n}" for n in lengths)}
            FROM gram
        ),
        inside AS (SELECT *, {under("r3", 3)} AS c3, {", ".join(f"{under(f'r{n}', n)} AS c{n}" for n in lengths)} FROM double),
        sums AS (
            SELECT doc, count(*) AS n_words, sum(chars) AS word_chars, sum(c3) AS n_repeat_words, sum(chars) FILTER (WHERE again) AS line_chars,
                {", ".join(f"sum(chars * c{n}) AS s{n}" for n in lengths)}
            FROM inside GROUP BY doc
        ),
        lines AS (SELECT doc, count(*) AS n_lines, count(*) FILTER (WHERE again) AS n_dup_lines FROM line GROUP BY doc),
        measured AS (
            SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
                (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
                coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
                {", ".join(f"{share(f's{n}', 'word_chars')} AS dup_{n}gram_share" for n in lengths)},
                {share("line_chars", "word_chars")} AS dup_line_char_share, {share("n_dup_lines", "n_lines")} AS dup_line_share
            FROM docs LEFT JOIN sums USING (doc) LEFT JOIN lines USING (doc)
        ),
        based AS (SELECT *, n_words < {ql.MIN_WORDS} OR 100 * n_repeat_words > {ql.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM measured)
        SELECT *, NOT base_failed AND dup_line_char_share <= {ql.LINE_CHAR_LIMIT} AND dup_line_share <= {ql.LINE_LIMIT}
            AND {" AND ".join(f"dup_{n}gram_share <= {limit}" for n, limit in ql.NGRAM_LIMITS.items())} AS kept
        FROM based
    """


#: The other queries rest on a trained model, a tokenizer or an iterative search; tests hold them against brute force.
LLM_ORACLES: dict[str, str] = {
    "op1_quality_rules": _quality_sql(),
    "op3_decontaminate": rf"""
        WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        item AS (
            SELECT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS g
            FROM (SELECT *, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS i FROM b WHERE len(w) > 0)
        ),
        sizes AS (SELECT DISTINCT n FROM item),
        run AS (
            SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
            FROM (SELECT d.*, s.n, unnest(generate_series(1, len(w) - s.n + 1)) AS i FROM d JOIN sizes s ON len(d.w) >= s.n)
        ),
        hit AS (SELECT r.doc_id, r.n, r.i, t.item_id FROM run r JOIN item t ON r.n = t.n AND r.g = t.g),
        place AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hit) GROUP BY doc_id),
        named AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
            FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id
        )
        SELECT d.doc_id, CAST(coalesce(len(d.w), 0) AS BIGINT) AS n_words, coalesce(p.n_hit, 0) AS n_hit, coalesce(n.n_items, 0) AS n_items,
            sha256(coalesce(n.items, '')) AS items_sha256,
            coalesce(p.n_hit, 0) > 0 AND 20 * coalesce(p.n_hit, 0) >= coalesce(len(d.w), 0) AS contaminated
        FROM d LEFT JOIN place p USING (doc_id) LEFT JOIN named n USING (doc_id)
    """,
    # Bytes as pairs of hexadecimal digits.
    "op4_suffix_dedup": """
        WITH docs AS (SELECT row_number() OVER () AS doc, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
        runs AS (
            SELECT doc, doc_id, p, md5_number(substr(x, 2 * p + 1, 200)) AS m
            FROM (SELECT *, unnest(generate_series(0, len(x) // 2 - 100)) AS p FROM docs)
        ),
        again AS (SELECT doc, p FROM (SELECT *, row_number() OVER (PARTITION BY m ORDER BY doc_id, p) AS nth FROM runs) WHERE nth > 1),
        turns AS (SELECT *, coalesce(p - lag(p) OVER (PARTITION BY doc ORDER BY p) > 100, true) AS turn FROM again),
        spans AS (
            SELECT doc, min(p) AS b, max(p) + 100 AS e
            FROM (SELECT *, sum(turn::INT) OVER (PARTITION BY doc ORDER BY p ROWS UNBOUNDED PRECEDING) AS nth FROM turns) GROUP BY doc, nth
        ),
        edges AS (
            SELECT doc, b, e FROM spans
            UNION ALL SELECT doc, len(x) // 2, len(x) // 2 FROM docs
        ),
        kept AS (
            SELECT doc, string_agg(substr(x, 2 * since + 1, 2 * (b - since)), '' ORDER BY b, e) AS y
            FROM (SELECT *, coalesce(lag(e) OVER (PARTITION BY doc ORDER BY b, e), 0) AS since FROM edges) JOIN docs USING (doc) GROUP BY doc
        ),
        sums AS (SELECT doc, count(*) AS n_spans, sum(e - b)::BIGINT AS n_removed FROM spans GROUP BY doc)
        SELECT doc_id, len(x) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(y)) AS kept_sha256
        FROM docs JOIN kept USING (doc) LEFT JOIN sums USING (doc)
    """,
    "op5_line_dedup": rf"""
        WITH whole AS (
            SELECT doc_id, list_filter(regexp_extract_all(coalesce(text, ''), '[^\n]*?(?:\n|[.!?][ \t]+|[\x{{3002}}\x{{FF01}}\x{{FF1F}}]|\z)'), lambda u: u <> '') AS us
            FROM documents
        ),
        unit AS (
            SELECT doc_id, p, l, w, len(w) AS n, {_LOWER.replace("text", "array_to_string(w, ' ')")} AS u
            FROM (SELECT *, regexp_extract_all(l, '[^\x20\x09-\x0D]+') AS w FROM (SELECT doc_id, unnest(us) AS l, generate_subscripts(us, 1) AS p FROM whole))
        ),
        worded AS (SELECT *, row_number() OVER (PARTITION BY u ORDER BY doc_id, p) > 1 AS again FROM unit WHERE n > 0),
        turns AS (SELECT *, coalesce(again <> lag(again) OVER (PARTITION BY doc_id ORDER BY p), true) AS turn FROM worded),
        runs AS (SELECT *, sum(turn::INT) OVER (PARTITION BY doc_id ORDER BY p ROWS UNBOUNDED PRECEDING) AS run FROM turns),
        gone AS (SELECT doc_id, p FROM (SELECT *, sum(n) OVER (PARTITION BY doc_id, run) AS total FROM runs) WHERE again AND total >= {ln.MIN_WORDS}),
        judged AS (SELECT unit.*, gone.p IS NOT NULL AS removed FROM unit LEFT JOIN gone USING (doc_id, p))
        SELECT doc_id, count(*) FILTER (WHERE n > 0) AS n_units, count(*) FILTER (WHERE removed) AS n_removed,
            CAST(coalesce(sum(strlen(l)) FILTER (WHERE removed), 0) AS BIGINT) AS removed_bytes,
            sha256(coalesce(string_agg(l, '' ORDER BY p) FILTER (WHERE NOT coalesce(removed, false)), '')) AS kept_sha256
        FROM documents LEFT JOIN judged USING (doc_id) GROUP BY doc_id
    """,
    # Every stretch has six equal words in a row at its period, so that six-word windows find it.
    "op12_periodic_runs": r"""
        WITH poly AS (  -- the 256 remainders of the CRC, by eight steps each
            SELECT i, list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS r
            FROM (SELECT unnest(generate_series(0::BIGINT, 255::BIGINT)) AS i)
        ),
        remainders AS (SELECT list(r ORDER BY i) AS t FROM poly),
        said AS (
            SELECT row_number() OVER () AS doc, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                CASE WHEN doc_id IS NULL THEN 1 ELSE xor(list_reduce(
                    list_concat([4294967295::BIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
                    lambda c, b: xor(c // 256, t[1 + xor(c % 256, b)])), 4294967295) END AS h
            FROM documents, remainders
        ),
        dealt AS (SELECT *, len(w) AS n, h // 10 AS g, (h // 10) % len(w) AS a FROM said),
        source AS (
            SELECT doc, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
                THEN list_transform(generate_series(0, n - 1), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE w END AS w
            FROM (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM dealt)
        ),
        word AS (SELECT doc, unnest(w) AS w, generate_subscripts(w, 1) - 1 AS i FROM source),
        gram AS (
            SELECT doc, i, w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o || ' ' || lead(w, 3) OVER o || ' ' || lead(w, 4) OVER o || ' ' || lead(w, 5) OVER o AS g
            FROM word WINDOW o AS (PARTITION BY doc ORDER BY i)
        ),
        pair AS (SELECT x.doc, x.i, y.i - x.i AS q FROM gram x JOIN gram y ON x.doc = y.doc AND x.g = y.g AND x.i < y.i),
        stretch AS (
            SELECT doc, q, min(i) AS start, count(*) + 5 + q AS length
            FROM (SELECT *, i - row_number() OVER (PARTITION BY doc, q ORDER BY i) AS k FROM pair) GROUP BY doc, q, k
        ),
        run AS (SELECT doc, start, length, min(q) AS period FROM stretch WHERE length >= greatest(12, 2 * q) GROUP BY doc, start, length),
        told AS (
            SELECT doc, count(*) AS n_runs, list({'start': start, 'length': length, 'period': period} ORDER BY length DESC, start, period)[1] AS b,
                string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
            FROM run GROUP BY doc
        ),
        gone AS (SELECT DISTINCT doc, unnest(generate_series(start + period, start + length - 1)) AS i FROM run),
        kept AS (SELECT doc, string_agg(w, ' ' ORDER BY i) AS body FROM word ANTI JOIN gone USING (doc, i) GROUP BY doc)
        SELECT doc_id, coalesce(n_runs, 0) AS n_runs, b.start AS start, b.length AS length, b.period AS period, 1000 * b.length // b.period AS exponent_milli,
            sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(body, '')) AS collapsed_sha256, n AS n_words
        FROM source LEFT JOIN told USING (doc) LEFT JOIN kept USING (doc)
    """,
    "op13_conversation_trie": r"""
        WITH turns AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS pos
            FROM conversations WHERE conv_id IS NOT NULL
        ),
        bits AS (SELECT DISTINCT conv_id, conv_id - conv_id % 20 AS base, CAST(conv_id AS VARCHAR) AS s FROM turns),
        poly AS (  -- the 256 remainders of the CRC, by eight steps each
            SELECT i, list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS r
            FROM (SELECT unnest(generate_series(0::BIGINT, 255::BIGINT)) AS i)
        ),
        remainders AS (SELECT list(r ORDER BY i) AS t FROM poly),
        hash AS (
            SELECT conv_id, base,
                xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(s, ''), lambda c: ascii(c)::BIGINT)),
                    lambda c, b: xor(c // 256, t[1 + xor(c % 256, b)])), 4294967295) % 4 AS h
            FROM bits, remainders
        ),
        firsts AS (SELECT h.conv_id, t.pos, t.role, t.text FROM hash h JOIN turns t ON t.conv_id = h.base AND t.pos < h.h),
        taken AS (SELECT h.conv_id, h.h, count(f.pos) AS m FROM hash h LEFT JOIN firsts f USING (conv_id) GROUP BY ALL),
        seq AS (
            SELECT conv_id, pos, role, text FROM firsts
            UNION ALL SELECT conv_id, t.pos - k.h + k.m, t.role, t.text FROM turns t JOIN taken k USING (conv_id) WHERE t.pos >= k.h
        ),
        conv AS (
            SELECT k.conv_id, coalesce(s.k, []) AS k, coalesce(s.w, []) AS w
            FROM taken k LEFT JOIN (
                SELECT conv_id, list(md5(length(role) || ':' || role || text) ORDER BY pos) AS k, list(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) ORDER BY pos) AS w
                FROM seq GROUP BY conv_id
            ) s USING (conv_id)
        ),
        path AS (
            SELECT conv_id, d, array_to_string(k[1:d], '') AS node, array_to_string(k[1:d - 1], '') AS up, coalesce(w[d], 0) AS words, d = len(k) AS ends, k
            FROM (SELECT *, unnest(generate_series(0, len(k))) AS d FROM conv)
        ),
        node AS (
            SELECT d, node, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n, any_value(words) AS words, any_value(k) AS k,
                sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
            FROM path GROUP BY d, node
        ),
        kids AS (SELECT d - 1 AS d, up AS node, count(*) AS n_children FROM node WHERE d > 0 GROUP BY ALL),
        sized AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN kids USING (d, node)),
        sub AS (
            SELECT e, array_to_string(k[1:e], '') AS node, sum((n - 1) * words) AS saved, count(*) FILTER (WHERE n_children = 0) AS leaves
            FROM (SELECT *, unnest(generate_series(0, d)) AS e FROM sized) GROUP BY ALL
        )
        SELECT s.conv_id, s.d AS depth, p.conv_id AS parent_conv_id, s.n AS n_convs, s.n_children, b.leaves AS n_leaves,
            CAST(b.saved AS BIGINT) AS saved_tokens, s.ends_sha256
        FROM sized s JOIN sub b ON b.e = s.d AND b.node = s.node LEFT JOIN node p ON s.d > 0 AND p.d = s.d - 1 AND p.node = s.up
    """,
}
