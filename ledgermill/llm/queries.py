"""The queries of this package: each applies one operator to its whole table and returns the agreed columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.llm import (
    conversations, decontamination, exact_dedup, language, ngram_lm, packing, passages, periodic, pii, quality, rules, simhash,
    substrings,
)
from ledgermill.llm.common import id_remainder, read
from ledgermill.session import stored

RUNNERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, oracle: str | None = None):
    def register(run):
        RUNNERS[name] = run
        if oracle:
            ORACLES[name] = oracle
        return run

    return register


@_query("op1_simhash")
def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    groups = simhash.near_groups(read(spark, folder, "documents"))
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return groups.select("doc_id", hexed.alias("fingerprint"), "component_id")


@_query("op2_language")
def op2_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    model = language.train(docs, id_remainder(F.col("doc_id"), 4) != 2)
    found = language.identify(docs, model)
    return found.select("doc_id", (id_remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score", "rejected")


@_query("op3_substrings", """
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
named AS (
  SELECT r, i, sha256(array_slice(b, i + 1, i + 200)) AS name
  FROM (SELECT r, b, unnest(range(octet_length(b) - 199)) AS i FROM docs WHERE octet_length(b) >= 200) starts),
again AS (SELECT r, i FROM named WHERE name IN (SELECT name FROM named GROUP BY name HAVING count(*) > 1)),
fresh AS (SELECT r, i, CASE WHEN i - lag(i) OVER (PARTITION BY r ORDER BY i) <= 200 THEN 0 ELSE 1 END AS opens FROM again),
numbered AS (SELECT r, i, sum(opens) OVER (PARTITION BY r ORDER BY i) AS run FROM fresh),
runs AS (SELECT r, run, min(i) AS a, max(i) + 200 AS z FROM numbered GROUP BY r, run),
gaps AS (SELECT r, a, z, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 0) AS behind FROM runs),
cut AS (
  SELECT r, sum(z - a) AS n_removed, count(*) AS n_spans, max(z) AS last,
         list_reduce(list(array_slice(b, behind + 1, a) ORDER BY a), lambda x, y: x || y) AS kept
  FROM gaps JOIN docs USING (r) GROUP BY r)
SELECT doc_id, octet_length(b) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(CASE WHEN kept IS NULL THEN b ELSE kept || array_slice(b, last + 1, octet_length(b)) END) AS kept_sha256
FROM docs LEFT JOIN cut USING (r)""")
def op3_substrings(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.remove_repeats(read(spark, folder, "documents")).drop("spans")


#: The patterns as another engine, without look-behind, reads them.
_PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": pii.PATTERNS["iban"],
}


def _pii_sql() -> str:
    """Spans from the lengths of the pieces between matches, validators over lists of digits."""
    digits = "list_transform(regexp_extract_all(m, '[0-9]'), lambda d: CAST(d AS INT))"
    doubled = f"list_transform(list_reverse({digits}), lambda d, i: CASE WHEN i % 2 = 1 THEN d WHEN d > 4 THEN 2 * d - 9 ELSE 2 * d END)"
    moved = "substr(replace(m, ' ', ''), 5) || substr(replace(m, ' ', ''), 1, 4)"
    signs = f"list_transform(regexp_extract_all({moved}, '.'), lambda c: CASE WHEN c <= '9' THEN c ELSE CAST(ascii(c) - 55 AS VARCHAR) END)"
    numbers = f"list_transform(regexp_extract_all(array_to_string({signs}, ''), '.'), lambda d: CAST(d AS INT))"
    checks = {
        "email": "TRUE",
        "ip": "len(list_filter(regexp_extract_all(m, '[0-9]+'), lambda p: CAST(right('000' || ltrim(p, '0'), 3) AS INT) > 255 OR length(ltrim(p, '0')) > 3)) = 0",
        "card": f"len({digits}) BETWEEN 13 AND 19 AND list_sum({doubled}) % 10 = 0",
        "phone": f"len({digits}) BETWEEN 9 AND 15",
        "iban": f"list_reduce({numbers}, lambda a, d: (10 * a + d) % 97) = 1",
    }
    parts = []
    for place, kind in enumerate(pii.KINDS):
        pattern = _PLAIN[kind]
        parts.append(f"""SELECT r, {place} AS place, '{kind}' AS kind, start, start + length(m) AS stop, {pii.BASE_SCORE[kind]} +
      CASE WHEN regexp_matches(right(gap, {pii.NEAR}), '{pii.CONTEXT[kind]}') THEN {pii.CONTEXT_BONUS} ELSE 0 END AS score
    FROM (SELECT r, gap, m, sum(length(gap)) OVER (PARTITION BY r ORDER BY k) + coalesce(sum(length(m)) OVER (PARTITION BY r ORDER BY k
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
          FROM (SELECT r, unnest(range(1, len(ms) + 1)) AS k, unnest(ms) AS m, unnest(gaps[1:len(ms)]) AS gap
                FROM (SELECT r, regexp_extract_all(body, '{pattern}', 0) AS ms, regexp_split_to_array(body, '{pattern}') AS gaps FROM docs) f) p) s
    WHERE {checks[kind]}""")
    joined = "array_to_string(list(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT) ORDER BY place, start)"
    counts = ", ".join(f"count(*) FILTER (kind = '{kind}') AS n_{kind}" for kind in pii.BASE_KINDS)
    base = f"place < {len(pii.BASE_KINDS)}"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS body FROM documents),
spans AS (
    {' UNION ALL '.join(parts)}),
per_doc AS (
  SELECT r, {counts}, {joined} FILTER ({base}), ',') AS base, {joined}, ',') AS spans,
         array_to_string(list(printf('%.2f', score) ORDER BY place, start), ',') AS scores
  FROM spans GROUP BY r)
SELECT doc_id, {', '.join(f'coalesce(n_{kind}, 0) AS n_{kind}' for kind in pii.BASE_KINDS)}, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans, coalesce(scores, '') AS scores
FROM docs LEFT JOIN per_doc USING (r)"""


@_query("op4_pii", _pii_sql())
def op4_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find(read(spark, folder, "documents"))
    base = [F.col(kind) for kind in pii.BASE_KINDS]
    every = [F.col(kind) for kind in pii.KINDS]
    scores = F.transform(F.concat(*every), lambda s: F.format_number(s["score"], 2))
    return found.select(
        "doc_id", *(F.size(kind).cast("long").alias(f"n_{kind}") for kind in pii.BASE_KINDS),
        F.sha2(pii.written(*base).cast("binary"), 256).alias("base_sha256"),
        pii.written(*every).alias("spans"), F.array_join(scores, ",").alias("scores"),
    )


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Place of a public tokenizer's file on this machine."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


@_query("op5_packing")
def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(read(spark, folder, "documents"), vocabulary())


@_query("op6_decontamination")
def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contaminated(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


@_query("op7_passages")
def op7_passages(spark: SparkSession, folder: str) -> DataFrame:
    return passages.repeated_passages(read(spark, folder, "documents"))


@_query("op8_exact_dedup", r"""
WITH norm AS (
  SELECT doc_id, coalesce(text, '') AS body, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS bare
  FROM documents),
ranked AS (
  SELECT doc_id, bare,
         first_value(doc_id) OVER (PARTITION BY bare ORDER BY length(body) DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY bare) AS group_size
  FROM norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(bare) AS text_sha256 FROM ranked""")
def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    groups = exact_dedup.exact_groups(read(spark, folder, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


@_query("op9_ngram_lm")
def op9_ngram_lm(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    remainder = id_remainder(F.col("doc_id"), 5)
    model = ngram_lm.train(docs, remainder != 1)
    found = ngram_lm.perplexities(docs, model)
    return found.select(
        "doc_id", (remainder == 1).alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score", "score", "perplexity",
    )


@_query("op10_quality")
def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    measured = stored(quality.measure(read(spark, folder, "documents")), "quality-statistics")
    remainder = id_remainder(F.col("doc_id"), 3)
    rules = quality.train(measured, read(spark, folder, "labels"), remainder != 1)
    scored = measured.select("doc_id", (remainder == 1).alias("held_out"), rules.score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


#: CRC-32 of the ASCII text ``{text}``, bit by bit, for an engine without the function.
_CRC32_SQL = """xor(4294967295, list_reduce(
      list_concat([4294967295], list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda state, byte: list_reduce([xor(state, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"""


def _repeating(docs: DataFrame) -> DataFrame:
    """Every tenth document by a hash of its identifier goes on periodically from one of its words, as the contract says."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))

    def periodic_text(words):
        n, g = F.size(words), F.floor(h / 10)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        block = F.slice(words, a + 1, p)
        tail = F.flatten(F.array_repeat(block, F.ceil((n - a) / p).cast("int")))
        return F.array_join(F.slice(F.concat(F.slice(words, F.lit(1), a), tail), F.lit(1), n), " ")

    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    named = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, periodic_text(w)).otherwise(F.lit("")))  # split once
    return docs.select("doc_id", F.when(h % 10 == 0, named[0]).otherwise(F.col("text")).alias("text"))


@_query("op13_periodic_runs", f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, {_CRC32_SQL.format(text="CAST(doc_id AS VARCHAR)")} AS h,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws
  FROM documents),
cut AS (SELECT *, len(ws) AS n, CASE WHEN h % 10 = 0 AND len(ws) > 0 THEN (h // 10) % len(ws) END AS a FROM docs),
placed AS (SELECT *, CASE WHEN a IS NOT NULL THEN 1 + (n - a) // (3 + (h // 10) % 8) END AS p FROM cut),
texts AS (
  SELECT r, doc_id, n, CASE WHEN a IS NULL THEN ws
         ELSE list_transform(range(n), lambda i: ws[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) END AS ws
  FROM placed),
words AS (SELECT r, unnest(range(n)) AS i, unnest(ws) AS w FROM texts),
fives AS (SELECT r, i, w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o || ' ' || lead(w, 3) OVER o || ' ' || lead(w, 4) OVER o AS name
          FROM words WINDOW o AS (PARTITION BY r ORDER BY i)),
alike AS (SELECT x.r, x.i, y.i - x.i AS q FROM fives x JOIN fives y ON x.r = y.r AND x.name = y.name AND x.i < y.i),
grouped AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM alike),
stretches AS (SELECT r, q, min(i) AS start, max(i) - min(i) + 5 + q AS length FROM grouped GROUP BY r, q, island),
runs AS (SELECT r, start, length, min(q) AS period FROM stretches WHERE length >= greatest(6, 4 * q) GROUP BY r, start, length),
edges AS (SELECT r, start + period AS i, 1 AS step FROM runs UNION ALL SELECT r, start + length, -1 FROM runs),
depth AS (SELECT r, i, sum(step) OVER (PARTITION BY r ORDER BY i) AS inside, lead(i) OVER (PARTITION BY r ORDER BY i) AS upto
          FROM (SELECT r, i, sum(step) AS step FROM edges GROUP BY r, i) e),
gone AS (SELECT DISTINCT r, unnest(range(i, upto)) AS i FROM depth WHERE inside > 0),
kept AS (SELECT r, string_agg(w, ' ' ORDER BY i) AS collapsed FROM words ANTI JOIN gone USING (r, i) GROUP BY r),
listed AS (
  SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs,
         arg_min(struct_pack(start, length, period), row(-length, start, period)) AS best FROM runs GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.start AS start, best.length AS length, best.period AS period,
       1000 * best.length // best.period AS exponent_milli, sha256(coalesce(runs, '')) AS runs_sha256,
       sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM texts LEFT JOIN listed USING (r) LEFT JOIN kept USING (r)""")
def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic.find_runs(_repeating(read(spark, folder, "documents")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    ranked = F.array_sort(F.transform("runs", lambda r: F.struct((-r["length"]).alias("shorter"), r["start"], r["period"])))
    best = F.get(ranked, F.lit(0))
    length = -best["shorter"]
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), length.alias("length"), best["period"].alias("period"),
        F.floor(1000 * length / best["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def _rules_sql() -> str:
    """Windows of words by their positions, lines by regular expressions."""
    limits = rules.Limits()
    quote = lambda text: text.replace("'", "''")
    count = lambda pattern: f"len(regexp_extract_all(line, '{quote(pattern)}'))"
    blanks = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    removed = ", ".join(f"count(*) FILTER (rule = '{rule}') AS n_{rule}" for rule in rules.RULES)
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS body,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS ws
  FROM documents),
words AS (SELECT r, unnest(range(len(ws))) AS i, unnest(ws) AS w FROM docs),
windows AS (SELECT r, i, w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o AS name
            FROM words WINDOW o AS (PARTITION BY r ORDER BY i)),
found AS (SELECT r, i, count(*) OVER (PARTITION BY r, name) AS n FROM windows WHERE name IS NOT NULL),
repeats AS (SELECT r, count(DISTINCT i) AS n_repeat_words FROM (SELECT r, i + unnest([0, 1, 2]) AS i FROM found WHERE n > 1) f GROUP BY r),
split AS (SELECT r, unnest(range(len(ls))) AS k, unnest(ls) AS whole FROM (SELECT r, string_split(body, chr(10)) AS ls FROM docs) s),
lines AS (SELECT r, k, trim(whole, {blanks}) AS line, row_number() OVER (PARTITION BY r, whole ORDER BY k) > 1 AS again
          FROM split WHERE trim(whole, {blanks}) <> ''),
measured AS (SELECT r, again, line, length(line) AS chars, {count('[^ \\x09-\\x0D]+')} AS n, {count('[' + rules.NOT_PROSE + ']')} AS signs,
                    {count(rules.DOUBLED)} AS doubled, {count(rules.SEPARATORS)} AS bars FROM lines),
judged AS (SELECT r, again, chars,
             CASE WHEN 20 * signs >= chars OR 4 * doubled > n THEN 'punctuation'
                  WHEN n >= {limits.long_line} AND NOT regexp_matches(line, '{quote(rules.ENDED)}') THEN 'punctuation'
                  WHEN bars >= 2 AND 4 * bars >= n THEN 'navigation'
                  WHEN regexp_matches(line, '{quote(rules.NOTICE)}') THEN 'boilerplate' END AS rule FROM measured),
per_doc AS (SELECT r, count(*) FILTER (again) AS n_dup_lines, {removed}, CAST(sum(chars) AS BIGINT) AS line_chars,
                   CAST(coalesce(sum(chars) FILTER (rule IS NOT NULL), 0) AS BIGINT) AS lost_chars FROM judged GROUP BY r),
counted AS (
  SELECT doc_id, len(ws) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
         len(regexp_extract_all(body, '[{rules.SYMBOLS}]')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, {", ".join(f"coalesce(n_{rule}, 0) AS n_{rule}" for rule in rules.RULES)},
         coalesce(line_chars, 0) AS line_chars, coalesce(lost_chars, 0) AS lost_chars,
         len(ws) < {limits.min_words} OR 100 * coalesce(n_repeat_words, 0) > {limits.max_repeated} * len(ws) AS base_failed
  FROM docs LEFT JOIN repeats USING (r) LEFT JOIN per_doc USING (r))
SELECT *, NOT base_failed AND 100 * lost_chars <= {limits.max_lost} * line_chars AS kept FROM counted"""


@_query("op12_quality_rules", _rules_sql())
def op12_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rules.clean(read(spark, folder, "documents")).drop("cleaned")


def _damaged(rows: DataFrame) -> DataFrame:
    """Rows of ``conversations`` dropped, emptied, cut, repeated or given to the user by a hash of their place, as the contract says."""
    space = F.lit(" ")
    place = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    rows = rows.select(
        "conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
        (F.crc32(place.cast("binary")) % 20).alias("kind"),
    )
    kind = F.col("kind")
    return rows.where(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


@_query("op11_conversation_repair", f"""
WITH RECURSIVE kinds AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_CRC32_SQL.format(text="coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM kinds WHERE kind <> 0),
convs AS (SELECT row_number() OVER () AS c, conv_id FROM (SELECT DISTINCT conv_id FROM conversations) d),
placed AS (
  SELECT c, turn, role, text, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
         row_number() OVER (PARTITION BY c, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
  FROM damaged JOIN convs ON damaged.conv_id IS NOT DISTINCT FROM convs.conv_id),
faulty AS (
  SELECT c, i, turn, role, text, left(role, 1) AS letter, lag(left(role, 1)) OVER (PARTITION BY c ORDER BY i) AS before,
         CASE WHEN bare = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM placed),
put_in(state, after, letters, cost, line) AS (VALUES
  ('b', 'b', '', 0, ''), ('s', 's', '', 0, ''), ('u', 'u', '', 0, ''), ('a', 'a', '', 0, ''),
  ('b', 'u', 'I', 5, chr(10) || 'user:'), ('s', 'u', 'I', 5, chr(10) || 'user:'), ('a', 'u', 'I', 5, chr(10) || 'user:'),
  ('u', 'a', 'I', 5, chr(10) || 'assistant:')),
edits(letter, state, after, role, first, cost) AS (VALUES
  ('K', 'b', 's', NULL, 's', 0), ('K', 'b', 'u', NULL, 'u', 0), ('K', 's', 'u', NULL, 'u', 0), ('K', 'u', 'a', NULL, 'a', 0), ('K', 'a', 'u', NULL, 'u', 0),
  ('R', 'b', 'u', 'user', NULL, 1), ('R', 's', 'u', 'user', NULL, 1), ('R', 'u', 'a', 'assistant', NULL, 1), ('R', 'a', 'u', 'user', NULL, 1),
  ('D', 'b', 'b', NULL, NULL, 2), ('D', 's', 's', NULL, NULL, 2), ('D', 'u', 'u', NULL, NULL, 2), ('D', 'a', 'a', NULL, NULL, 2)),
ways AS (
  SELECT c, CAST(0 AS BIGINT) AS i, 'b' AS state, '000000000' AS best, '' AS made FROM convs
  UNION ALL
  SELECT c, i, state, min(best), arg_min(made, best)
  FROM (
    SELECT w.c, w.i + 1 AS i, e.after AS state,
           printf('%09d', CAST(left(w.best, 9) AS INT) + p.cost + e.cost + CASE WHEN e.letter <> 'D' AND f.fault = 'truncated' THEN 5 ELSE 0 END)
             || substr(w.best, 10) || p.letters || e.letter AS best,
           w.made || p.line || CASE WHEN e.letter = 'D' THEN '' ELSE chr(10) || coalesce(e.role, f.role) || ':' || f.text END AS made
    FROM ways w JOIN faulty f ON f.c = w.c AND f.i = w.i + 1 JOIN put_in p ON p.state = w.state
      JOIN edits e ON e.state = p.after AND (e.letter = 'D' OR f.fault IN ('', 'truncated')) AND (e.first IS NULL OR e.first = f.letter)) x
  GROUP BY c, i, state),
stats AS (
  SELECT c, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || letter NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY c),
ended AS (
  SELECT w.c, min(printf('%09d', CAST(left(w.best, 9) AS INT) + p.cost) || substr(w.best, 10) || p.letters) AS best,
         arg_min(w.made || p.line, printf('%09d', CAST(left(w.best, 9) AS INT) + p.cost) || substr(w.best, 10) || p.letters) AS made
  FROM ways w JOIN stats ON stats.c = w.c AND stats.n = w.i JOIN put_in p ON p.state = w.state WHERE p.after IN ('b', 'a') GROUP BY w.c)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(CAST(left(best, 9) AS BIGINT), 0) AS cost, coalesce(substr(best, 10), '') AS audit,
       sha256(coalesce(substr(made, 2), '')) AS repaired_sha256
FROM convs LEFT JOIN stats USING (c) LEFT JOIN ended USING (c)""")
def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    given = read(spark, folder, "conversations")
    found = conversations.repair(_damaged(given))
    hashes = conversations.digests(found.turns).select(F.col("conv_id").alias("hashed_id"), "sha256")
    summary = found.summary.withColumnRenamed("conv_id", "summed_id")
    every = given.select("conv_id").distinct()
    every = every.join(summary, every["conv_id"].eqNullSafe(summary["summed_id"]), "left")
    every = every.join(hashes, every["conv_id"].eqNullSafe(hashes["hashed_id"]), "left")
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return every.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", nothing).alias("repaired_sha256"))
