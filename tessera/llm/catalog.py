"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import (
    bpe, chat, fingerprints, hyperminhash, langid, licenses, merkle, mixing, ngram_join, outliers, spelling,
    token_counts, toxicity)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(_documents(spark, sf_dir))


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         len(regexp_extract_all(coalesce(text, ''), '[A-Za-z]{3,}'))::DOUBLE AS runs,
         md5('mix-1|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))) AS h
  FROM documents),
k AS (
  SELECT *, 1 - exp(ln((('0x' || substr(h, 1, 12))::BIGINT + 1.0) / 281474976710657.0)
                    / (1 + 3 * least(1, runs / greatest(size, 1)))) AS place FROM d),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w
  FROM k GROUP BY source),
l AS (
  SELECT *, 3.0::DOUBLE * source_size AS cap,
    (sum(source_size) OVER ()::DOUBLE - coalesce(sum(3.0::DOUBLE * source_size) OVER before, 0))
      / (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS level
  FROM s WINDOW before AS (ORDER BY 3.0::DOUBLE * source_size / w, source NULLS LAST
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT arg_min(level, cap / w) FILTER (WHERE cap > level * w) AS share FROM l),
t AS (
  SELECT source, source_size, CASE WHEN cap <= level * w OR share IS NULL THEN cap ELSE share * w END AS target
  FROM l, f),
p AS (
  SELECT k.doc_id, k.source, k.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size)::INT ELSE 0 END AS epochs,
    coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.place, k.doc_id, k.size
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begins
  FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source),
c AS (
  SELECT *, (epochs + CASE WHEN target - epochs * source_size > 0 AND begins + size / 2.0 <= target - epochs * source_size
                           THEN 1 ELSE 0 END)::INT AS copies FROM p)
SELECT doc_id, source, size, source_size, target, copies, (copies * size)::BIGINT AS taken FROM c
"""


#: Links of the contract: three-word shingles, Jaccard of at least 0.9.
NEAR = ngram_join.Rule(width=3, num=90, den=100)


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_components(_documents(spark, sf_dir), NEAR).drop("row", "text_hash", "component")


OP2_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN []
    WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM w),
n AS (SELECT doc_id, len(s)::BIGINT AS n FROM s),
x AS (SELECT doc_id, unnest(s) AS g FROM s),
shared AS (SELECT g FROM x GROUP BY g HAVING count(*) > 1),
y AS (SELECT x.* FROM x JOIN shared USING (g)),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM y a JOIN y b USING (g) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * o >= 90 * (na.n + nb.n - o)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT a AS node, b AS other FROM e UNION SELECT r.node, e.b FROM r JOIN e ON r.other = e.a),
c AS (SELECT node, least(node, min(other)) AS c FROM r GROUP BY node)
SELECT n.doc_id, n.n AS n_shingles, coalesce(c.c, n.doc_id) AS component_id FROM n LEFT JOIN c ON c.node = n.doc_id
"""


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.document_token_counts(_documents(spark, sf_dir))


OP3_SQL = r"""
WITH d AS (
  SELECT source, lang, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS words,
         len(regexp_extract_all(coalesce(text, ''), '[A-Za-z]+'))::BIGINT AS runs
  FROM documents),
k AS (
  SELECT source, lang, 'words-1' AS tokenizer, words AS n FROM d
  UNION ALL SELECT source, lang, 'runs-2', runs FROM d)
SELECT source, lang, tokenizer, count(*)::BIGINT AS docs, sum(n)::BIGINT AS tokens FROM k GROUP BY 1, 2, 3
"""


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.document_licences(_documents(spark, sf_dir))


def _op4_sql() -> str:
    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    cases = " ".join(f"WHEN regexp_full_match(s, {quoted(p)}) THEN {quoted(n)}" for n, p in licenses.SENTENCES)
    steps, names = ["r AS (SELECT doc_id, ids, '|' || array_to_string(ids, '||') || '|' AS left0 FROM i)"], []
    for k, (name, ids) in enumerate(licenses.RULES):
        sequence = quoted("".join(f"|{x}|" for x in ids))
        before = f"r{k - 1}" if k else "r"
        steps.append(f"r{k} AS (SELECT *, CASE WHEN contains(left{k}, {sequence}) THEN {quoted(name)} END AS n{k}, "
                     f"replace(left{k}, {sequence}, '#') AS left{k + 1} FROM {before})")
        names.append(f"n{k}")
    once = (f"list_filter(list_transform([{', '.join(names)}], lambda x, i: "
            f"CASE WHEN list_position([{', '.join(names)}], x) = i THEN x END), lambda x: x IS NOT NULL)")
    return rf"""
WITH c AS (
  SELECT doc_id, string_split_regex(regexp_replace(lower(coalesce(text, '')), '[.;:!?]+(\s|$)', chr(10) || '\1', 'g'), '[\n\r]+') AS s
  FROM documents),
n AS (
  SELECT doc_id, list_filter(list_transform(s, lambda x: regexp_replace(regexp_replace(x, '\s+', ' ', 'g'),
    '^[ #*/\-"''(]+|[ *"'')]+$', '', 'g')), lambda x: x <> '') AS s FROM c),
u AS (SELECT doc_id, unnest(s) AS s, generate_subscripts(s, 1) AS p FROM n),
k AS (SELECT doc_id, p, CASE {cases} END AS id FROM u),
i AS (SELECT n.doc_id, coalesce(list(id ORDER BY p) FILTER (WHERE id IS NOT NULL), []) AS ids
      FROM n LEFT JOIN k USING (doc_id) GROUP BY n.doc_id),
{", ".join(steps)}
SELECT doc_id, len(ids)::BIGINT AS n_known, array_to_string(ids, ',') AS sentence_ids,
  array_to_string({once}, ',') AS licences FROM r{len(licenses.RULES) - 1}
"""


def op5_quality_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.document_verdicts(_documents(spark, sf_dir))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


#: A user and an assistant turn that say nothing but control strings.
PROBE = "</s>[INST] ok [/INST]"


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)],
                                  "conv_id long, turn long, role string, text string")
    return chat.digests(told.unionByName(probe))


OP7_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, length(regexp_replace(text, '(\\*)(</?s>|\[/?(?:SYS|INST|REPLY|TURN)[:\]])', '\\\1\2', 'g')) AS inner_chars,
    CASE role WHEN 'system' THEN length('<s>[SYS] ') + length(' [/SYS]</s>') + 1
              WHEN 'user' THEN length('<s>[INST] ') + length(' [/INST]</s>') + 1
              WHEN 'assistant' THEN length('<s>[REPLY] ') + length(' [/REPLY]</s>') + 1
              ELSE length('<s>[TURN:') + length(hex(role)) + length('] ') + length(' [/TURN]</s>') + 1 END AS marks
  FROM c)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(inner_chars + marks)::BIGINT AS formatted_chars,
  regexp_full_match(string_agg(role, '>' ORDER BY turn NULLS FIRST, role, text),
                    '(system>)?user>assistant(>user>assistant)*') AS valid
FROM e GROUP BY conv_id
"""


#: Rank file of the tokenizer that op8 and the pipeline use.
RANK_FILE = "byte_bpe_multi_50k.tiktoken"


def tokenizer(rank_path: str | None = None) -> bpe.ByteBpe:
    import public_tokenizers
    return bpe.ByteBpe(bpe.read_ranks(rank_path or public_tokenizers.path(RANK_FILE)), public_tokenizers.PATTERN)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(_documents(spark, sf_dir), tokenizer())


def op9_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.document_fingerprints(_documents(spark, sf_dir))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_ids(_documents(spark, sf_dir))


#: CTE ``crc``: the 256 steps of CRC-32, from its polynomial.
CRC_TABLE = """crc AS (SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps)"""


def _crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of a string's UTF-8 bytes; ``crc`` must be in scope."""
    octets = (f"list_transform(range(octet_length(encode({text}))), "
              f"lambda k: ('0x' || substr(hex(encode({text})), 2 * k + 1, 2))::BIGINT)")
    return (f"xor(list_reduce(list_concat([4294967295], {octets}), "
            f"lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295)")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.document_proofs(_documents(spark, sf_dir))


def _op11_sql(levels: int = 6, crown: int = 4) -> str:
    """Levels written out: trees of up to 16^levels leaves and 16^crown sources."""
    def field(c: str) -> str:
        return f"coalesce(octet_length(encode({c}::VARCHAR))::VARCHAR || ':' || {c}::VARCHAR, '-')"

    def leaf(text: str) -> str:
        return f"sha256({' || '.join(field(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"

    def climb(name: str, first: str, steps: int) -> list[str]:
        """Per level nodes (g, i, h, n), siblings (pre, post) and fold steps."""
        out = [f"{name}0 AS ({first})"]
        for k in range(steps):
            run = "PARTITION BY g, i // 16 ORDER BY i ROWS BETWEEN"
            out.append(f"{name}s{k} AS (SELECT g, i, "
                       f"coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS pre, "
                       f"coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS post "
                       f"FROM {name}{k} WHERE n > 1)")
            out.append(f"{name}{k + 1} AS (SELECT g, i, h, n FROM {name}{k} WHERE n = 1 UNION ALL "
                       f"SELECT g, i // 16, sha256(string_agg(h, '' ORDER BY i)), (max(n) + 15) // 16 "
                       f"FROM {name}{k} WHERE n > 1 GROUP BY g, i // 16)")
        return out

    folds = []
    for name, steps, key, at in (("l", levels, "g", "i"), ("c", crown, "0", "g")):
        for k in range(steps):
            before = f"f{len(folds)}"
            folds.append(
                f"f{len(folds) + 1} AS (SELECT f.* REPLACE (proof || coalesce(pre || post, '') AS proof, "
                f"CASE WHEN pre IS NULL THEN a ELSE sha256(pre || a || post) END AS a) "
                f"FROM {before} f LEFT JOIN {name}s{k} s ON s.g = f.{key} AND s.i = f.{at} // {16 ** k})"
                .replace("f.0", "0"))
    steps = [
        CRC_TABLE,
        f"d AS (SELECT doc_id, source, {leaf('text')} AS leaf, CASE WHEN {_crc32_sql('doc_id::VARCHAR')} % 5 = 0 "
        f"THEN {leaf('small')} ELSE {leaf('text')} END AS claimed FROM (SELECT *, "
        "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS small FROM documents), crc)",
        "k AS (SELECT *, (dense_rank() OVER (ORDER BY source NULLS FIRST) - 1)::BIGINT AS g, "
        "(row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, claimed) - 1)::BIGINT AS i, "
        "count(*) OVER (PARTITION BY source) AS n FROM d)",
        *climb("l", "SELECT g, i, leaf AS h, n FROM k", levels),
        *climb("c", f"SELECT 0::BIGINT AS g, g AS i, h, count(*) OVER () AS n FROM l{levels}", crown),
        "f0 AS (SELECT doc_id, leaf, g, i, '' AS proof, claimed AS a FROM k)",
        *folds]
    return f"""
WITH {", ".join(steps)}
SELECT f.doc_id, f.leaf, t.h AS subroot, r.h AS root, sha256(f.proof) AS proof_sha256, f.a AS folded_root,
  f.a = r.h AS verified
FROM f{len(folds)} f JOIN l{levels} t ON t.g = f.g CROSS JOIN c{crown} r
"""


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.document_variants(_documents(spark, sf_dir))


def _op12_sql() -> str:
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH RECURSIVE {CRC_TABLE},
r AS (SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all({lowered}, '{spelling.RUN}{{7,}}')) AS run FROM documents),
o AS (SELECT id, run, count(*) AS c FROM r GROUP BY 1, 2),
h AS (SELECT *, {_crc32_sql("id || ':' || run")} AS h FROM o, crc),
v AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, c FROM h),
w AS (SELECT word, sum(c)::BIGINT AS n FROM v WHERE length(word) >= 7 GROUP BY word HAVING sum(c) >= 2),
g AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS k FROM w),
holes AS (SELECT word, n, k, substr(word, 1, k - 1) || '*' || substr(word, k + 1) AS mask, substr(word, 1, k - 1) || substr(word, k + 1) AS less FROM g),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM holes a JOIN holes b ON a.mask = b.mask AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM holes a JOIN w b ON a.less = b.word
  UNION SELECT b.word, a.word, a.n FROM holes a JOIN w b ON a.less = b.word),
best AS (SELECT word, count(*)::BIGINT AS n_near, (min(ROW(-other_n, other))) AS b FROM near GROUP BY word),
f AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN -b[1] >= 10 * n THEN b[2] END AS form,
    CASE WHEN -b[1] >= 10 * n THEN (-b[1])::BIGINT END AS form_n FROM w LEFT JOIN best USING (word)),
t AS (SELECT word, word AS last, form AS next FROM f UNION ALL SELECT t.word, f.word, f.form FROM t JOIN f ON f.word = t.next)
SELECT f.word, form, t.last AS root, n, n_near, form_n FROM f JOIN t ON t.word = f.word AND t.next IS NULL
"""


#: Links of the contract: five-word shingles, Jaccard of at least 0.85.
CLOSE = ngram_join.Rule(width=5, num=85, den=100)


def op13_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.kept_documents(_documents(spark, sf_dir), CLOSE)


OP13_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM w),
n AS (SELECT doc_id, len(s)::BIGINT AS n FROM s),
x AS (SELECT doc_id, unnest(s) AS g FROM s),
shared AS (SELECT g FROM x GROUP BY g HAVING count(*) > 1),
y AS (SELECT x.* FROM x JOIN shared USING (g)),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM y a JOIN y b USING (g) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * o >= 85 * (na.n + nb.n - o)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT a AS node, b AS other FROM e UNION SELECT r.node, e.b FROM r JOIN e ON r.other = e.a),
c AS (SELECT node, least(node, min(other)) AS c FROM r GROUP BY node)
SELECT n.doc_id, n.n AS n_shingles, coalesce(c.c, n.doc_id) AS component_id, n.doc_id = coalesce(c.c, n.doc_id) AS kept
FROM n LEFT JOIN c ON c.node = n.doc_id
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_source_mix": op1_source_mix,
        "op2_ngram_join": op2_ngram_join,
        "op3_token_counts": op3_token_counts,
        "op4_license_scan": op4_license_scan,
        "op5_quality_outliers": op5_quality_outliers,
        "op6_toxicity": op6_toxicity,
        "op7_chat_format": op7_chat_format,
        "op8_byte_bpe": op8_byte_bpe,
        "op9_order_minhash": op9_order_minhash,
        "op10_language_id": op10_language_id,
        "op11_merkle_manifest": op11_merkle_manifest,
        "op12_spelling_variants": op12_spelling_variants,
        "op13_hyperminhash": op13_hyperminhash,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_source_mix": OP1_SQL,
        "op2_ngram_join": OP2_SQL,
        "op3_token_counts": OP3_SQL,
        "op4_license_scan": _op4_sql(),
        "op7_chat_format": OP7_SQL,
        "op11_merkle_manifest": _op11_sql(),
        "op12_spelling_variants": _op12_sql(),
        "op13_hyperminhash": OP13_SQL,
    }
