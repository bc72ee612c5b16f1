"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.llm import (bitplane, blobledger, fptree, langid, licences, minhash, ordinal, pareto, subspace,
                          triecount, turnrepair, urltrie, wumanber)
from newsflow.llm.common import crc32_of, documents, read_table, staging_path


def op1_bitplane_tokens(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    import public_tokenizers
    docs = documents(spark, sf_dir) if docs is None else docs
    path = staging_path(spark, "tokens")
    bitplane.encode_to_files(docs, path, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return bitplane.read_files(spark, path).select(
        F.col("key").alias("doc_id"), "start", "n_tokens", "ids_crc32", "part", "shard")


def op2_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir))


#: A-Z to a-z and the words of a text, as lists.
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "coalesce(regexp_extract_all(" + _LOWER + ", '[^\\x20\\x09-\\x0D]+'), [])"

_OP2 = f"""
WITH RECURSIVE t AS (SELECT doc_id, {_WORDS.format('text')} AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
      FROM t),
x AS (SELECT doc_id, unnest(s) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM x a JOIN x b ON a.g = b.g AND a.doc_id < b.doc_id
      GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN s u ON u.doc_id = a JOIN s v ON v.doc_id = b
      WHERE 100 * i >= 75 * (len(u.s) + len(v.s) - i)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS c FROM s UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id WHERE r.c < e.b)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, min(c) AS component_id, doc_id = min(c) AS kept
FROM r JOIN s USING (doc_id) GROUP BY doc_id, s"""


def op3_subspace_pigeonhole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subspace.near_vectors(read_table(spark, sf_dir, "embeddings"))


_OP3 = """
WITH RECURSIVE u AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
g AS (SELECT * FROM u WHERE label IS NOT NULL AND len(v) > 0
  AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_inner_product(v, v) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM g a JOIN g b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_inner_product(a.v, b.v) / sqrt(list_inner_product(a.v, a.v) * list_inner_product(b.v, b.v)) >= 0.98),
r AS (SELECT vec_id, vec_id AS c FROM u UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.vec_id WHERE r.c < l.b),
n AS (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(any_value(n), 0) AS n_links, min(c) AS component_id, vec_id = min(c) AS kept
FROM r LEFT JOIN n USING (vec_id) GROUP BY vec_id"""


def op4_wumanber_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wumanber.report(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


_OP4_WORDS = ("coalesce(regexp_extract_all(" + _LOWER
              + ", '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), [])")

_OP4 = f"""
WITH d AS (SELECT doc_id, {_OP4_WORDS.format('text')} AS w FROM documents),
i AS (SELECT item_id, {_OP4_WORDS.format('text')} AS w FROM benchmark),
p AS (SELECT DISTINCT item_id, k, array_to_string(w[j:j + k - 1], ' ') AS g
      FROM (SELECT item_id, w, least(10, len(w)) AS k, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS j
            FROM i WHERE len(w) > 0)),
g AS (SELECT doc_id, k, j, array_to_string(w[j:j + k - 1], ' ') AS g
      FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS j FROM d, (SELECT DISTINCT k FROM p))),
h AS (SELECT doc_id, g.k, j, item_id FROM g JOIN p USING (k, g)),
n AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(j, j + k)) AS x FROM h) GROUP BY doc_id),
m AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
        sha256(array_to_string(list_sort(list_distinct(list(CAST(item_id AS VARCHAR)))), ',')) AS s FROM h GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(s, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)"""


RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op5_url_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    return urltrie.judge(read_table(spark, sf_dir, "pages"), rules)


_OP5 = f"""
WITH r(host, path, action) AS (VALUES {', '.join(str(r) for r in RULES)}),
u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS u FROM pages),
p AS (SELECT page_id, {_LOWER.format("regexp_extract(u, '^[^/?#]*')")} AS host,
  regexp_extract(substr(u, len(regexp_extract(u, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM u),
f AS (SELECT page_id, arg_max(r.host || r.path, len(r.host || r.path)) AS rule, arg_max(action, len(r.host || r.path)) AS action
  FROM p JOIN r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path) GROUP BY page_id)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule, coalesce(action, 'allow') AS verdict
FROM p LEFT JOIN f USING (page_id)"""


def op6_trie_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return triecount.token_counts(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op7_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return licences.scan(docs, licences.train(docs))


def op8_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pareto.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def _op8() -> str:
    rounds, pool = [], "c0"
    for k in range(1, pareto.ROUNDS + 1):
        rounds.append(f"""
f{k} AS (SELECT doc_id, sum(size) OVER (PARTITION BY source ORDER BY p, doc_id ROWS UNBOUNDED PRECEDING) AS upto, lack
  FROM {pool} WHERE open AND size <= lack),
c{k} AS (SELECT c.* EXCLUDE (open, lack, extra), extra OR coalesce(upto <= f.lack, false) AS extra,
  open AND NOT coalesce(upto <= f.lack, false) AS open,
  c.lack - sum(CASE WHEN upto <= f.lack THEN size ELSE 0 END) OVER (PARTITION BY source) AS lack
  FROM {pool} c LEFT JOIN f{k} f USING (doc_id))""")
        pool = f"c{k}"
    cases = " ".join(f"WHEN {j} THEN {float(w)}" for j, w in enumerate(pareto.WEIGHTS))
    return f"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM d GROUP BY source),
w AS (SELECT *, CASE place % {len(pareto.WEIGHTS)} {cases} END AS w, source_size * {float(pareto.MOST)} AS cap FROM s),
v AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, place ROWS BETWEEN UNBOUNDED PRECEDING
  AND 1 PRECEDING), 0)) / sum(w) OVER (ORDER BY cap / w, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
l AS (SELECT arg_min(level, cap / w) AS level FROM v WHERE level <= cap / w),
t AS (SELECT source, source_size, least(cap, (SELECT level FROM l) * w) AS target FROM w),
e AS (SELECT d.*, source_size, target, least({float(pareto.MOST)}, target * 1.0 / source_size) AS e,
  (CAST(('0x' || substr(md5('8:' || doc_id), 1, 13)) AS BIGINT) + 0.5) / 4503599627370496.0 AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
o AS (SELECT *, floor(e) AS whole, e - floor(e) AS odds FROM e),
q AS (SELECT *, odds > 0 AND size > 0 AS open, u / (1 - u) / (odds / (1 - odds)) AS q FROM o),
c0 AS (SELECT *, q / (1 + q) AS p, false AS extra,
  floor(round(target - sum(whole * size) OVER (PARTITION BY source), 6)) AS lack FROM q),{','.join(rounds)}
SELECT doc_id, size, source_size, round(target, 6) AS target,
  CAST((whole + CAST(extra AS INT)) * size AS BIGINT) AS taken FROM {pool}"""


def op9_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return ordinal.judge(docs, ordinal.train(docs, read_table(spark, sf_dir, "labels")))


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return langid.predict(docs, langid.train(docs))


def damaged_turns(turns: DataFrame) -> DataFrame:
    """``conversations`` with faults put in by a hash of conversation and turn: rows dropped,
    emptied, without end marks, repeated or said by the user."""
    space = F.lit(" ")
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), space))
    h = crc32_of(key) % 20
    return turns.select(
        "conv_id", "turn", F.when(h == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(h == 1, F.lit("")).when(h == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        h.alias("h")).where("h <> 0").select(
        "conv_id", "turn", "role", "text", F.explode(F.when(F.col("h") == 3, F.array(F.lit(0), F.lit(1)))
                                                     .otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def op11_four_russians_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations")
    report = turnrepair.repair(damaged_turns(turns)).report
    # conversations of which no row is left
    every = turns.select(F.col("conv_id").alias("of")).distinct()
    zero, nothing = F.lit(0).cast("long"), F.lit("")
    return every.join(report, F.col("conv_id").eqNullSafe(F.col("of")), "left").select(
        F.col("of").alias("conv_id"),
        *[F.coalesce(c, zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", nothing).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(nothing, 256)).alias("repaired_sha256"))


def _crc32(text: str) -> str:
    """crc32 of a column of ASCII text: the table of bytes, then one step a byte."""
    step = "xor({0} >> 1, 3988292384 * ({0} & 1))"
    table = "c"
    for _ in range(8):
        table = f"list_transform({table}, lambda x: {step.format('x')})"
    table = table.replace("(c,", "(range(256),", 1)
    return (f"xor(list_reduce(list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT)), "
            f"lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295), 4294967295)", table)


def _op11() -> str:
    value, table = _crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")
    options = []   # the ways to each state over one row: delete, keep, rerole; each with its empty turns before
    ins = {0: [(0, 0, "", "")], 1: [(1, 0, "", "")], 2: [(2, 0, "", "")], 3: [(3, 0, "", "")]}
    for q in ins:
        state, cost, letters, said = ins[q][0]
        for _ in range(2):
            given, state = turnrepair.GIVEN[state]
            cost, letters, said = cost + 5, letters + "I", said + f"\n{given}:"
            ins[q].append((state, cost, letters, said))
    for q in range(4):
        for mid, cost, letters, said in ins[q]:
            options.append((mid, q, cost + 2, letters + "D", said, "true", "''"))
            live = "NOT (blank OR dup)"
            for (a, initial), b in turnrepair.NEXT.items():
                if a == mid:
                    options.append((b, q, cost, letters + "K", said, f"{live} AND role[1] = '{initial}'", "role"))
            given, b = turnrepair.GIVEN[mid]
            options.append((b, q, cost + 1, letters + "R", said, live, f"'{given}'"))

    def best(ways):
        return f"list_min(list_filter([{', '.join(ways)}], lambda z: z IS NOT NULL))"

    into = []
    for state in range(4):
        ways = []
        for b, q, cost, letters, said, when, role in options:
            if b == state:
                dead = letters.endswith("D")
                more = "" if dead else " + 5 * CAST(trunc AS INT)"
                line = "" if dead else f" || chr(10) || {role} || ':' || text"
                put = said.replace("\n", "' || chr(10) || '")
                ways.append(f"CASE WHEN s{q} IS NOT NULL AND {when} THEN {{'c': s{q}.c + {cost}{more}, "
                            f"'a': s{q}.a || '{letters}', 't': s{q}.t || '{put}'{line}}} END")
        into.append(f"{best(ways)} AS s{state}")
    ends = [f"CASE WHEN s{q} IS NOT NULL THEN {{'c': s{q}.c + {5 * len(tail)}, 'a': s{q}.a || '{'I' * len(tail)}', "
            f"'t': s{q}.t || '{''.join(chr(10) + r + ':' for r in tail)}'}} END"
            for q, tail in turnrepair.TAIL.items()]
    return f"""
WITH RECURSIVE crc AS MATERIALIZED (SELECT {table} AS t),
h AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {value} % 20 AS h FROM conversations, crc),
g AS (SELECT conv_id, turn, CASE h WHEN 4 THEN 'user' ELSE role END AS role,
  CASE h WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
  unnest(range(CASE h WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM h WHERE h <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS n FROM g),
f AS (SELECT conv_id, turn, role, text, n, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
  row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 AS dup,
  NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\\z') AS trunc,
  lag(role[1]) OVER (PARTITION BY conv_id ORDER BY n) || role[1] AS pair FROM o),
w AS (SELECT conv_id, CAST(0 AS BIGINT) AS n, {{'c': 0, 'a': '', 't': ''}} AS s0, CAST(NULL AS STRUCT(c INT, a VARCHAR, t VARCHAR)) AS s1,
  CAST(NULL AS STRUCT(c INT, a VARCHAR, t VARCHAR)) AS s2, CAST(NULL AS STRUCT(c INT, a VARCHAR, t VARCHAR)) AS s3
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL SELECT conv_id, f.n, {', '.join(into)}
  FROM (SELECT w.*, f.* EXCLUDE (conv_id, n), f.n AS m FROM w JOIN f ON w.conv_id IS NOT DISTINCT FROM f.conv_id AND f.n = w.n + 1) AS f(
    conv_id, old, s0, s1, s2, s3, turn, role, text, blank, dup, trunc, pair, n)),
z AS (SELECT conv_id, {best(ends)} AS s FROM w
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY n DESC) = 1),
k AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
  count(*) FILTER (blank) AS blank, count(*) FILTER (dup AND NOT blank) AS duplicate,
  count(*) FILTER (trunc AND NOT dup AND NOT blank) AS truncated,
  count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id)
SELECT z.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(s.c AS BIGINT) AS cost, s.a AS audit,
  sha256(substr(s.t, 2)) AS repaired_sha256
FROM z LEFT JOIN k ON z.conv_id IS NOT DISTINCT FROM k.conv_id"""


def op12_blob_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = blobledger.scan(documents(spark, sf_dir), staging_path(spark, "ledger"))
    base = [r.kind for r in blobledger.BASE]
    return found.select(
        "doc_id", *[F.size(blobledger.of_kinds(F.col("spans"), [k])).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(blobledger.written(blobledger.of_kinds(F.col("spans"), base)), 256).alias("base_sha256"),
        blobledger.written(F.col("spans")).alias("spans"))


def _op12() -> str:
    kinds = []
    for place, rule in enumerate(blobledger.RULES):
        p = rule.pattern.replace("'", "''")
        own = f"regexp_extract(m, '{p}', {rule.group})"
        kinds.append(f"""
SELECT doc_id, {place} AS place, '{rule.kind}' AS kind, a, a + len(m) AS b FROM (
  SELECT doc_id, m, list_sum(list_transform(s[:j], lambda x: len(x))) + coalesce(list_sum(list_transform(e[:j - 1],
    lambda x: len(x))), 0) AS a
  FROM (SELECT doc_id, s, e, unnest(range(1, len(e) + 1)) AS j, unnest(e) AS m
    FROM (SELECT doc_id, regexp_split_to_array(text, '{p}') AS s, regexp_extract_all(text, '{p}') AS e
      FROM documents WHERE regexp_matches(text, '{p}'))))
WHERE len({own}) >= {rule.least}""")
    spelled = "string_agg(kind || ':' || CAST(a AS BIGINT) || ':' || CAST(b AS BIGINT), ',' ORDER BY a, place)"
    counts = ", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in blobledger.BASE)
    return f"""
WITH f AS ({' UNION ALL '.join(kinds)}),
g AS (SELECT doc_id, {', '.join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in blobledger.BASE)},
  {spelled} FILTER (place < {len(blobledger.BASE)}) AS base, {spelled} AS spans FROM f GROUP BY doc_id)
SELECT doc_id, {counts}, sha256(coalesce(base, '')) AS base_sha256, coalesce(g.spans, '') AS spans
FROM documents LEFT JOIN g USING (doc_id)"""


def op13_fp_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fptree.search(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


_TERMS = "coalesce(regexp_extract_all(" + _LOWER + ", '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'), [])"

_OP13 = f"""
WITH d AS (SELECT doc_id, {_TERMS.format('text')} AS w FROM documents),
c AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d WHERE len(w) > 0),
i AS (SELECT DISTINCT item_id, unnest({_TERMS.format('text')}) AS term FROM benchmark),
x AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM d)
  WHERE term IN (SELECT term FROM i) GROUP BY ALL),
v AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM x GROUP BY term), c),
s AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * n_docs) // n_terms)))))
    AS BIGINT) AS score FROM i JOIN x USING (term) JOIN v USING (term), c GROUP BY item_id, doc_id),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
  FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM r WHERE rank <= 10"""


QUERIES = {
    "op1_bitplane_tokens": op1_bitplane_tokens,
    "op2_circulant_minhash": op2_circulant_minhash,
    "op3_subspace_pigeonhole": op3_subspace_pigeonhole,
    "op4_wumanber_decontamination": op4_wumanber_decontamination,
    "op5_url_trie": op5_url_trie,
    "op6_trie_counts": op6_trie_counts,
    "op7_licence_scan": op7_licence_scan,
    "op8_pareto_mix": op8_pareto_mix,
    "op9_ordinal_quality": op9_ordinal_quality,
    "op10_langid": op10_langid,
    "op11_four_russians_repair": op11_four_russians_repair,
    "op12_blob_ledger": op12_blob_ledger,
    "op13_fp_tree_search": op13_fp_tree_search,
}

SQL: dict[str, str] = {
    "op2_circulant_minhash": _OP2,
    "op3_subspace_pigeonhole": _OP3,
    "op4_wumanber_decontamination": _OP4,
    "op5_url_trie": _OP5,
    "op8_pareto_mix": _op8(),
    "op11_four_russians_repair": _op11(),
    "op12_blob_ledger": _op12(),
    "op13_fp_tree_search": _OP13,
}
