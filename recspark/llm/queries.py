"""Registered queries of the text operators, with SQL twins where SQL can say it.

Each query applies its operator to the whole of its table with production
parameters and derives the digest columns of its contract from the operator's
real output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recspark.llm import (archives, chat, decontaminate, exact_dedup, language, licenses,
                          line_dedup, merkle, packing, simhash, spelling, substrings,
                          token_counts)
from recspark.session import apply_query_conf

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_query_conf(spark)
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        REGISTRY[name] = run
        if sql:
            SQL[name] = sql
        return run
    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query("op1_license_scan")
def op1_license_scan(spark, d):
    """Licence notices in every whole text, with coverage and spans."""
    return licenses.scan_licenses(spark, table(spark, d, "documents"))


@query("op2_exact_dedup", r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t
  FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept,
       sha256(t) AS text_sha256
FROM n""")
def op2_exact_dedup(spark, d):
    """Stateful streaming dedup of every whole text."""
    out = exact_dedup.duplicate_groups(spark, table(spark, d, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept",
                      F.col("digest").alias("text_sha256"))


@query("op3_arc_to_warc", r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h FROM pages),
r AS (SELECT *, min(page_id) OVER (PARTITION BY t) AS first_id FROM p)
SELECT page_id, CAST(strlen(t) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr(
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + CAST((CAST('0x' || substr(h, CAST(i // 4 * 5 + 1 AS INTEGER), 5) AS INTEGER)
                   >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31 AS INTEGER), 1)), '')
         AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM r""")
def op3_arc_to_warc(spark, d):
    """Pages to ARC, ARC to WARC with revisits, read back."""
    return archives.archive_round_trip(spark, table(spark, d, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op4_language_id")
def op4_language_id(spark, d):
    """PPM code lengths of every whole text; learned from the rows not held out."""
    docs = table(spark, d, "documents")
    model = language.train(spark, language.labelled_rows(docs))
    return language.predict(spark, docs, model).select(
        "doc_id", language.held_out_column(F.col("doc_id")).alias("held_out"),
        "lang_pred", "score")


@query("op5_simhash")
def op5_simhash(spark, d):
    """SimHash components of all documents by covering hashing."""
    return simhash.near_duplicates(spark, table(spark, d, "documents"))


@query("op6_suffix_array_dedup", r"""
WITH b AS (SELECT doc_id, encode(coalesce(text, '')) AS t, hex(encode(coalesce(text, ''))) AS h
           FROM documents),
w AS (SELECT doc_id, p, substr(h, CAST(2 * p + 1 AS INTEGER), 100) AS g
      FROM (SELECT doc_id, h, unnest(range(octet_length(t) - 49)) AS p FROM b
            WHERE octet_length(t) >= 50)),
f AS (SELECT g, min(doc_id) AS first_id FROM w GROUP BY g HAVING min(doc_id) < max(doc_id)),
x AS (SELECT doc_id, p, max(p) OVER (PARTITION BY doc_id ORDER BY p
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS q
      FROM w JOIN f USING (g) WHERE doc_id > first_id),
s AS (SELECT doc_id, p, sum(CASE WHEN q IS NULL OR p > q + 50 THEN 1 ELSE 0 END)
             OVER (PARTITION BY doc_id ORDER BY p) AS run FROM x),
r AS (SELECT doc_id, run, min(p) AS lo, max(p) + 50 AS hi FROM s GROUP BY doc_id, run),
k AS (SELECT doc_id, lo, hi, lag(hi, 1, 0) OVER (PARTITION BY doc_id ORDER BY lo) AS before,
             lead(lo) OVER (PARTITION BY doc_id ORDER BY lo) AS after FROM r),
j AS (SELECT doc_id, sum(hi - lo) AS n_removed, count(*) AS n_spans,
             string_agg(substr(h, CAST(2 * before + 1 AS INTEGER),
                               CAST(2 * (lo - before) AS INTEGER))
               || CASE WHEN after IS NULL THEN substr(h, CAST(2 * hi + 1 AS INTEGER)) ELSE '' END,
               '' ORDER BY lo) AS kept
      FROM k JOIN b USING (doc_id) GROUP BY doc_id)
SELECT b.doc_id, CAST(octet_length(t) AS BIGINT) AS n_bytes,
       CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM b LEFT JOIN j USING (doc_id)""")
def op6_suffix_array_dedup(spark, d):
    """Bytes of repeated 50-byte strings, by suffix arrays over shards."""
    return substrings.remove_repeats(spark, table(spark, d, "documents"))


@query("op7_line_dedup")
def op7_line_dedup(spark, d):
    """Lines of all documents with an earlier line of Jaccard similarity 0.8 or more."""
    return line_dedup.mark_lines(spark, table(spark, d, "documents"))


@query("op8_decontaminate", r"""
WITH dw AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
iw AS (
  SELECT CAST(item_id AS VARCHAR) AS item, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark),
ig AS (
  SELECT DISTINCT item, least(len(w), 10) AS k,
         array_to_string(list_slice(w, p, p + least(len(w), 10) - 1), ' ') AS g
  FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p
        FROM iw WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM ig),
dg AS (
  SELECT doc_id, k, p, array_to_string(list_slice(w, p, p + k - 1), ' ') AS g
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p
        FROM dw, ks WHERE len(w) >= k)),
m AS (SELECT doc_id, p, k, item FROM dg JOIN ig USING (k, g)),
hw AS (SELECT doc_id, count(DISTINCT x) AS n_hit
       FROM (SELECT doc_id, unnest(range(p, p + k)) AS x FROM (SELECT DISTINCT doc_id, p, k FROM m))
       GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s
       FROM (SELECT DISTINCT doc_id, item FROM m) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hw USING (doc_id) LEFT JOIN it USING (doc_id)""")
def op8_decontaminate(spark, d):
    """Winnowed benchmark windows in every whole text."""
    out = decontaminate.find_contamination(spark, table(spark, d, "documents"),
                                           table(spark, d, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"),
                        lambda acc, x: acc + x["end"] - x["start"])
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"),
                      F.size("items").cast("bigint").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                      (F.size("spans") > 0).alias("contaminated"))


@query("op9_token_counts")
def op9_token_counts(spark, d):
    """Unigram token counts and best scores of every whole text."""
    return token_counts.count_tokens(spark, table(spark, d, "documents"))


@query("op10_best_fit_packing")
def op10_best_fit_packing(spark, d):
    """Token pieces of all documents and their places in sequences of 2048."""
    return packing.pack(spark, table(spark, d, "documents"))


def _crc32_sql(text: str) -> str:
    """Unsigned crc32 of a text's UTF-8, bit by bit: DuckDB has no function for it."""
    byte = f"('0x' || substr(hex(encode({text})), CAST(2 * i + 1 AS INTEGER), 2))::UBIGINT"
    return f"""xor(list_reduce(
      list_transform(range(octet_length(encode({text}))), lambda i: {byte}),
      lambda crc, b: list_reduce(range(8)::UBIGINT[],
        lambda c, i: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END),
        xor(crc, b)), 4294967295::UBIGINT), 4294967295::UBIGINT)"""


@query("op11_spelling_variants", rf"""
WITH RECURSIVE o AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS d, unnest(regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[a-z\x{{C0}}-\x{{FF}}]+')) AS r FROM documents),
h AS (SELECT r, count(*) AS n, {_crc32_sql("d || ':' || r")} AS h FROM o GROUP BY d, r),
w AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(r, 1, CAST(h % length(r) AS INTEGER))
              || substr(r, CAST(h % length(r) AS INTEGER) + 2) ELSE r END AS word,
         CAST(sum(n) AS BIGINT) AS n
  FROM h GROUP BY 1 HAVING length(word) >= 5 AND sum(n) >= 3),
x AS (SELECT DISTINCT word, i, substr(word, 1, CAST(i AS INTEGER) - 1)
             || substr(word, CAST(i AS INTEGER) + 1) AS t
      FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM w)),
p AS (SELECT a.word AS a, b.word AS b FROM x a JOIN x b ON a.t = b.t AND a.i = b.i
      WHERE a.word <> b.word
      UNION SELECT x.word, w.word FROM x JOIN w ON x.t = w.word
      UNION SELECT w.word, x.word FROM x JOIN w ON x.t = w.word),
q AS (SELECT a, count(*) AS n_near, first(b ORDER BY n DESC, b) AS best, max(n) AS m
      FROM p JOIN w ON w.word = p.b GROUP BY a),
f AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * n THEN best END AS form,
             CASE WHEN m >= 2 * n THEN m END AS form_n
      FROM w LEFT JOIN q ON q.a = w.word),
s AS (SELECT word, coalesce(form, word) AS root, form IS NULL AS done FROM f
      UNION ALL SELECT s.word, coalesce(f.form, s.root), f.form IS NULL
      FROM s JOIN f ON f.word = s.root WHERE NOT s.done)
SELECT f.word, form, root, n, n_near, form_n FROM f JOIN s ON s.word = f.word AND s.done""")
def op11_spelling_variants(spark, d):
    """Words of all whole texts, their near words and forms, by a variable-length gram index."""
    return spelling.variants(spark, spelling.vocabulary(spark, table(spark, d, "documents")))


PROBE = "</s>[INST] ok [/INST]"


@query("op12_chat_formatting", r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, length(regexp_replace(role, c, '\1\\\2', 'g'))
          + length(regexp_replace(text, c, '\1\\\2', 'g')) + 17 AS chars
  FROM t, (SELECT '([<\[]\\*)(s>|INST\]|/INST\]|/s>|\|endoftext\|>)' AS c))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), ''
                         ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, ''
                         ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
       CAST(3 + sum(chars) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id""")
def op12_chat_formatting(spark, d):
    """All conversations formatted and encoded once, read back from text, offsets and mask."""
    rows = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).selectExpr("-1L AS conv_id", "id AS turn",
                                      "if(id = 0, 'user', 'assistant') AS role",
                                      f"'{PROBE}' AS text")
    return chat.read_back(chat.format_conversations(spark, rows.unionByName(probe)))


def _merkle_sql(height: int = 5, above: int = 3) -> str:
    """Trees of up to 16 ** height leaves a source, and 16 ** above sources."""
    def leaf(text):
        return "sha256(" + " || ".join(
            f"CASE WHEN {c} IS NULL THEN '-' ELSE octet_length(encode(CAST({c} AS VARCHAR))) "
            f"|| ':' || CAST({c} AS VARCHAR) END"
            for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    run = "PARTITION BY {g}p // 16 ORDER BY p ROWS BETWEEN"
    parts = [f"""d AS (
  SELECT doc_id, source, {leaf("text")} AS node,
         CASE WHEN {_crc32_sql("CAST(doc_id AS VARCHAR)")} % 5 = 0
              THEN {leaf(lower)} ELSE {leaf("text")} END AS alt FROM documents),
a0 AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, node) - 1 AS p,
              count(*) OVER (PARTITION BY source) AS n FROM d)"""]

    def level(name, k, group, columns):
        g, same = f"{group}, " if group else "", f"GROUP BY {group + ', ' if group else ''}p // 16, n"
        window = run.format(g=g)
        out = [f"""{name}{k}s AS (
  SELECT {columns}, p, n, node,
         coalesce(string_agg(node, '') OVER ({window} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(node, '') OVER ({window} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name}{k})"""]
        out.append(f"""{name}{k + 1} AS (
  SELECT {g}p // 16 AS p, CASE WHEN n = 1 THEN min(node)
         ELSE sha256(string_agg(node, '' ORDER BY p)) END AS node, (n + 15) // 16 AS n
  FROM {name}{k} {same})""")
        return out

    for k in range(height):
        parts += level("a", k, "source", "source, doc_id, alt" if k == 0 else "source")
    parts.append(f"""b0 AS (SELECT source, node, count(*) OVER () AS n,
       row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS p FROM a{height})""")
    for k in range(above):
        parts += level("b", k, "", "source" if k == 0 else "1 AS one")
    steps = [("a0s", "")] + [
        (f"a{k}s", f"a{k}s.source IS NOT DISTINCT FROM a0s.source AND a{k}s.p = a0s.p // {16 ** k}")
        for k in range(1, height)]
    steps.append(("b0s", "b0s.source IS NOT DISTINCT FROM a0s.source"))
    steps += [(f"b{k}s", f"b{k}s.p = b0s.p // {16 ** k}") for k in range(1, above)]
    proof = [f"CASE WHEN {n}.n = 1 THEN '' ELSE {n}.l || {n}.r END" for n, _ in steps]
    parts.append("w AS (SELECT a0s.doc_id, a0s.node AS leaf, a0s.alt AS alt, b0s.node AS subroot, "
                 + "sha256(" + " || ".join(proof) + ") AS proof_sha256, "
                 + ", ".join(f"{n}.n AS n{i}, {n}.l AS l{i}, {n}.r AS r{i}"
                             for i, (n, _) in enumerate(steps))
                 + " FROM a0s " + " ".join(f"JOIN {n} ON {on}" for n, on in steps[1:]) + ")")
    last = "w"
    for i in range(len(steps)):
        parts.append(f"f{i} AS (SELECT * REPLACE (CASE WHEN n{i} = 1 THEN alt "
                     f"ELSE sha256(l{i} || alt || r{i}) END AS alt) FROM {last})")
        last = f"f{i}"
    return ("WITH " + ",\n".join(parts) + f"""
SELECT doc_id, leaf, subroot, b{above}.node AS root, proof_sha256, alt AS folded_root,
       alt = b{above}.node AS verified FROM {last}, b{above}""")


@query("op13_merkle_manifest", _merkle_sql())
def op13_merkle_manifest(spark, d):
    """Digest tree of all documents, and each one's proof checked after tampering."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    values = [F.col(c) for c in merkle.LEAF_COLUMNS]
    lowered = [*values[:-1], F.translate("text", upper, upper.lower())]
    chosen = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    tampered = F.when(chosen, merkle.leaf_digest(lowered))
    made = merkle.build(spark, table(spark, d, "documents"), carry={"tampered": tampered})
    folded = merkle.fold(F.coalesce("tampered", "leaf"), F.col("path"))
    return merkle.proofs(made).select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root",
        F.sha2(merkle.path_text(F.col("path")), 256).alias("proof_sha256"),
        folded.alias("folded_root"), (folded == F.col("root")).alias("verified"))
