"""Registered queries of this subpackage and their SQL.

Each ``opN_*`` applies operator N to its whole table and derives the digest
columns that its contract names.
"""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vidpulse.llm import byte_bpe, chat_format, digest_tree, merkle_manifest, mix_budget, pii_spans, quality_gbt, quality_rules, secret_markov, simhash_trie, spans, token_align, token_orc, warc_chunks
from vidpulse.llm.common import scratch_path, written

Query = Callable[[SparkSession, str], DataFrame]
RANKS = "byte_bpe_multi_50k.tiktoken"


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc_chunks.archive(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    last = warc_chunks.read_archives(manifest, with_data=False).where("last")
    stored = F.col("record_type") == "response"  # a revisit states size and digest of what it refers to
    return last.select(
        warc_chunks.page_of(F.col("record")).alias("page_id"),
        F.when(stored, F.col("bytes_so_far")).otherwise(F.col("stated_bytes")).alias("payload_bytes"),
        F.when(stored, F.col("digest_so_far")).otherwise(F.col("stated_digest")).alias("payload_digest"),
        "record_type", warc_chunks.page_of(F.col("refers_to")).alias("refers_to"))


def op2_digest_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_tree.exact_groups(_documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op3_quality_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    trees = quality_gbt.train_on(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_gbt.score(docs, trees).withColumnRenamed("id", "doc_id")


def op4_secret_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_markov.scan_secrets(_documents(spark, sf_dir))
    return found.select(
        F.col("row.doc_id").alias("doc_id"), *[spans.count_of(F.col("base"), k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(spans.joined(F.col("base")), 256).alias("base_sha256"), spans.joined(F.col("all")).alias("spans"))


def op5_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_trie.near_groups(_documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.assess(_documents(spark, sf_dir)).select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ids = byte_bpe.encode(_documents(spark, sf_dir), public_tokenizers.path(RANKS), public_tokenizers.PATTERN, with_ids=False)
    return ids.select(F.col("id").alias("doc_id"), "n_tokens", "ids_sha256", "decoded_sha256", "n_split")


def op8_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_spans.scan(_documents(spark, sf_dir)).select(
        F.col("row.doc_id").alias("doc_id"), *[spans.count_of(F.col("base"), k).alias(f"n_{k}") for k in ("email", "ip", "card", "phone")],
        F.sha2(spans.joined(F.col("base")), 256).alias("base_sha256"), spans.joined(F.col("all")).alias("spans"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chat_format.records_of_rows(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    control = F.lit("</s>[INST] ok [/INST]")  # conversation -7 comes in another layout
    extra = spark.range(1).select(F.lit(-7).cast("long").alias("conv_id"), F.struct(control.alias("prompt"), control.alias("completion")).alias("record"))
    out = written(chat_format.format_structs(rows).union(chat_format.format_structs(extra)), "chat")
    text = F.col("formatted")
    read = out.select("conv_id", "formatted", chat_format.read_turns(text).alias("turns"), chat_format.read_loss(text, F.col("loss")).alias("loss"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


def op10_mix_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_budget.plan_mix(_documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.translate("text", ascii_uppercase, ascii_lowercase)).otherwise(F.col("text"))
    return merkle_manifest.prove(_documents(spark, sf_dir), ["doc_id", "source", "lang", "n_chars", "text"], presented={"text": tampered}).select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op12_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch_path(spark, "token-orc")
    token_orc.write_ids(_documents(spark, sf_dir), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_orc.ids_crc32(token_orc.read_ids(spark, path))


def op13_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    aligned = written(token_align.align(_documents(spark, sf_dir), *paths), "align")
    return token_align.score(aligned).withColumnRenamed("id", "doc_id")


QUERIES: dict[str, Query] = {
    q.__name__: q for q in (
        op1_warc_chunks, op2_digest_tree, op3_quality_gbt, op4_secret_markov, op5_simhash_trie, op6_quality_rules, op7_byte_bpe, op8_pii_spans, op9_chat_format, op10_mix_budget,
        op11_merkle_manifest, op12_token_orc, op13_token_align)}

_WS = r"[ \t\n\x0B\x0C\r]"
_WORDS = f"list_filter(string_split_regex(coalesce(text, ''), '{_WS}+'), lambda x: x <> '')"
_STOPS = ", ".join(f"'{w}'" for w in sorted(set(quality_rules.STOP_WORDS)))
_CONTROL = r"[<\[]\\*(?:s>|/s>|/?INST\]|<SYS>>|</SYS>>|\|im_start\|>|\|im_sep\|>|\|im_end\|>|\|endoftext\|>)"


def _rules_sql() -> str:
    ratio = {
        "mean_word_chars": "word_chars / n_words", "symbol_ratio": "n_symbols / word_chars", "shout_ratio": "n_shout / n_words",
        "stop_ratio": "n_stop / n_words", "dup_line_ratio": "n_dup_lines / n_lines", "echo_ratio": "n_echo / n_words"}
    rules = [f"{ratio[name]} {sign} {bound}" for name, least, most in quality_rules.RULES for sign, bound in ((">=", least), ("<=", most)) if bound is not None]
    return f"""
        WITH t AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
        starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM t),
        twice AS (SELECT doc_id, i FROM starts
                  QUALIFY count(*) OVER (PARTITION BY doc_id, array_to_string(w[i:i + 7], ' ')) > 1),
        covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(0, 8) r(k) GROUP BY doc_id),
        s AS (SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
                     length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
                     list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ \\t\\n\\x0B\\x0C\\r]')) AS lines,
                     CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
                     len(list_filter(w, lambda x: lower(x) IN ({_STOPS}))) AS n_stop,
                     len(list_filter(w, lambda x: suffix(x, '!!'))) AS n_shout,
                     len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_echo
              FROM t LEFT JOIN covered USING (doc_id)),
        r AS (SELECT *, len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
                     n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM s)
        SELECT doc_id, n_words, word_chars, n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines, n_repeat_words, base_failed,
               NOT base_failed AND {' AND '.join(rules)} AS kept FROM r"""


#: Levels that the manifest's SQL spells out: 8 ** 7 documents of a language, 8 ** 4 languages.
_DOC_LEVELS, _LANG_LEVELS = 7, 4


def _tree_sql(name: str, source: str, tree: str, levels: int) -> str:
    """``{name}n<k>``: nodes (tree, i, h, m: nodes of the level) of each level; ``{name}r<k>``: their runs."""
    out = f"{name}n0 AS (SELECT {tree} AS tree, i, h, count(*) OVER (PARTITION BY {tree}) AS m FROM {source}),"
    for k in range(levels):
        out += f"""
        {name}r{k} AS (SELECT tree, i // 8 AS p, m, list(h ORDER BY i) AS run FROM {name}n{k} GROUP BY ALL),
        {name}n{k + 1} AS (SELECT tree, p AS i, CASE WHEN m = 1 THEN run[1] ELSE sha256(array_to_string(run, '')) END AS h, (m + 7) // 8 AS m FROM {name}r{k}),"""
    return out


def _fold_sql(name: str, levels: int, start: str, step: str) -> str:
    """Joins each row of ``start`` (tree, i, own, seen, proof) to its run, level by level."""
    out = f"{step}0 AS ({start}),"
    for k in range(levels):
        slot = f"(i // {8**k}) % 8"
        before, after = f"array_to_string(run[1:{slot}], '')", f"array_to_string(run[{slot} + 2:], '')"
        out += f"""
        {step}{k + 1} AS (SELECT s.* REPLACE (
            CASE WHEN m = 1 THEN own ELSE sha256({before} || own || {after}) END AS own,
            CASE WHEN m = 1 THEN seen ELSE sha256({before} || seen || {after}) END AS seen,
            CASE WHEN m = 1 THEN proof ELSE proof || {before} || {after} END AS proof)
            FROM {step}{k} s JOIN {name}r{k} r ON s.tree = r.tree AND s.i // {8 ** (k + 1)} = r.p),"""
    return out


def _manifest_sql() -> str:
    field = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    fields = lambda text: " || ".join(map(field, ("doc_id", "source", "lang", "n_chars", text)))
    crc = """xor(list_reduce([4294967295] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
        lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda r, z: xor(r >> 1, 3988292384 * (r & 1)))), 4294967295)"""
    lower = f"CASE WHEN {crc} % 3 = 0 THEN translate(text, '{ascii_uppercase}', '{ascii_lowercase}') ELSE text END"
    return f"""
        WITH t AS (SELECT doc_id, lang, sha256({fields('text')}) AS h, sha256({fields(f'({lower})')}) AS changed FROM documents),
        d AS (SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g,
                     row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h) - 1 AS i FROM t),
        {_tree_sql('d', 'd', 'g', _DOC_LEVELS)}
        g AS (SELECT tree AS i, h FROM dn{_DOC_LEVELS}),
        {_tree_sql('g', 'g', '0', _LANG_LEVELS)}
        {_fold_sql('d', _DOC_LEVELS, "SELECT doc_id, g AS tree, i, h AS leaf, h AS own, changed AS seen, '' AS proof FROM d", 'a')}
        {_fold_sql('g', _LANG_LEVELS, f"SELECT doc_id, 0 AS tree, tree AS i, leaf, own AS subroot, own, seen, proof FROM a{_DOC_LEVELS}", 'b')}
        z AS (SELECT * FROM b{_LANG_LEVELS})
        SELECT doc_id, leaf, subroot, own AS root, sha256(proof) AS proof_sha256, seen AS folded_root, seen = own AS verified FROM z"""


SQL = {
    "op1_warc_chunks": """
        WITH t AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages)
        SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
               array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + (
                   (CAST('0x' || substr(h, CAST(k // 4 * 5 + 1 AS INTEGER), 5) AS BIGINT) >> CAST(15 - k % 4 * 5 AS INTEGER)) & 31) AS INTEGER), 1)), '') AS payload_digest,
               CASE WHEN page_id = max(page_id) OVER g THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> max(page_id) OVER g THEN max(page_id) OVER g END AS refers_to
        FROM t WINDOW g AS (PARTITION BY html)""",
    "op2_digest_tree": rf"""
        WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '{_WS}+', ' ', 'g') AS norm FROM documents)
        SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = min(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
        FROM t WINDOW g AS (PARTITION BY norm)""",
    "op6_quality_rules": _rules_sql(),
    "op9_chat_format": rf"""
        WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                   UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
                   UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
        s AS (SELECT *, len(regexp_extract_all(role, '{_CONTROL}')) + len(regexp_extract_all(text, '{_CONTROL}')) AS escapes FROM t)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
               CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
               sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
               CAST(sum(length(role) + length(text) + escapes + {len(chat_format.START + chat_format.SEP + chat_format.END) + 1}) AS BIGINT) AS formatted_chars
        FROM s GROUP BY conv_id""",
    "op11_merkle_manifest": _manifest_sql(),
}
