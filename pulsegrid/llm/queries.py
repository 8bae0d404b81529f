"""One query per operator over its whole table, with the SQL that checks it where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm import edit_prints, filter_audit, fuzzy_lines, licences, minhash, packing, pages, pieces, prefix_trie, quality, rules, toxicity, urls
from pulsegrid.llm.common import UPPER, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
URL_RULES = "allow org/, block example.org/es/, block example.org/en/1, allow com/fr/, block com/de/"


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def _licence_sql() -> str:
    known = ", ".join(f"('{k}', '{s}')" for k, s in licences.SENTENCES.items())
    steps = ["s0 AS (SELECT doc_id, ids, '<' || array_to_string(ids, '><') || '>' AS rest FROM grouped)"]
    for i, (_, _, ids) in enumerate(licences.RULES):
        keep, run = ", ".join(["doc_id", "ids", *(f"h{j}" for j in range(i))]), "<" + "><".join(ids) + ">"
        steps.append(f"s{i + 1} AS (SELECT {keep}, contains(rest, '{run}') AS h{i}, replace(rest, '{run}', '|') AS rest FROM s{i})")

    def hit(column: int) -> str:
        each = ", ".join(f"CASE WHEN h{i} THEN '{r[column]}' END" for i, r in enumerate(licences.RULES))
        return f"array_to_string(list_sort(list_distinct(list_filter([{each}], lambda x: x IS NOT NULL))), ',')"

    return f"""
        WITH known(id, sentence) AS (VALUES {known}),
        hinted AS (SELECT doc_id, text FROM documents WHERE regexp_matches(text, '{licences.HINTS}')),
        cut AS (SELECT doc_id, string_split(regexp_replace(regexp_replace(text, '\\n[ \\t*#/]*([a-z])', ' \\1', 'g'),
                    '([.!?;:])[ \\t\\r]+', '\\1' || chr(10), 'g'), chr(10)) AS parts FROM hinted),
        flat AS (SELECT doc_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS pos FROM cut),
        named AS (SELECT doc_id, pos, id FROM flat
                  JOIN known ON sentence = trim(regexp_replace(lower(part), '[^a-z0-9]+', ' ', 'g'))),
        grouped AS (SELECT doc_id, list(id ORDER BY pos) AS ids FROM named GROUP BY doc_id),
        {", ".join(steps)}
        SELECT doc_id, array_to_string(ids, ',') AS sentence_ids, {hit(1)} AS licences, {hit(0)} AS licence_rules,
               replace(trim(replace(replace(replace(rest, '|', ''), '><', ','), '<', ''), '>'), '|', '') AS unmatched
        FROM s{len(licences.RULES)}"""


# The prior weight of a level: children with their parent's mean, by moments.
_WEIGHT = """
    (SELECT CASE WHEN coalesce(n, 0) = 0 OR k < 2 OR noise = 0 OR room <= 0 OR share <= 0 THEN 200.0
                 ELSE least(200.0, greatest(2.0, 1 / share - 1)) END
     FROM (SELECT *, (spread - noise / n * (k - 1)) / room AS share
           FROM (SELECT *, noise / n * (n - nn / n - (k - 1)) AS room
                 FROM (SELECT sum(n)::DOUBLE AS n, sum(n * n)::DOUBLE AS nn, count(*) AS k,
                              sum(n * pow(good / n - mean, 2)) AS spread, sum(n * mean * (1 - mean)) AS noise FROM {0}))))"""


def _url_sql() -> str:
    split = {"host": f"translate(regexp_extract(url, '{urls.PARTS}', 2), '{UPPER}', '{UPPER.lower()}')", "path": f"regexp_extract(url, '{urls.PARTS}', 3)"}
    two = rf"(?:^|\.)((?:{'|'.join(urls.SECOND_LEVEL)})\.[a-z]{{2}})$"
    rules, fits = sorted(urls.rules_from(URL_RULES), key=lambda r: -len(r.text)), []
    for r in rules:
        fits.append((f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')", r))
    text = "CASE " + " ".join(f"WHEN {f} THEN '{r.text}'" for f, r in fits) + " END"
    verdict = "CASE " + " ".join(f"WHEN {f} THEN '{r.verdict}'" for f, r in fits) + " END"
    level = lambda child, parent, on, keys: f"""
        {child}0 AS (SELECT {keys}, sum(n) AS n, sum(good) AS good FROM hosts GROUP BY ALL),
        {child}1 AS (SELECT c.*, p.mean FROM {child}0 c JOIN {parent} p ON {on}),
        {child}2 AS (SELECT *, {_WEIGHT.format(child + "1")} AS m FROM {child}1),
        {child} AS (SELECT {keys}, n, good, good + m * mean AS a, n - good + m * (1 - mean) AS b,
                    (good + m * mean) / (n + m) AS mean FROM {child}2)"""  # noqa: E731
    return f"""
        WITH judged AS (SELECT page_id, coalesce({split["host"]}, '') AS host, coalesce({split["path"]}, '') AS path FROM pages),
        outcomes AS (SELECT host, quality AS good FROM judged
                     JOIN labels ON doc_id = try_cast(regexp_extract(path, '^/[^/]*/([0-9]{{1,18}})', 1) AS BIGINT)),
        named AS (SELECT *, CASE WHEN regexp_matches(host, '{two}') THEN regexp_extract(host, '{two}', 1)
                                 ELSE regexp_extract(host, '([^.]*)$', 1) END AS suffix FROM outcomes),
        domains AS (SELECT *, CASE WHEN host = suffix THEN host
                    ELSE regexp_extract(left(host, length(host) - length(suffix) - 1), '([^.]*)$', 1) || '.' || suffix END AS domain FROM named),
        hosts AS (SELECT suffix, domain, host, count(*) AS n, sum(good)::BIGINT AS good FROM domains GROUP BY ALL),
        total AS (SELECT (coalesce(sum(good), 0) + 1) / (coalesce(sum(n), 0) + 2) AS mean FROM hosts),
        {level("suffixes", "total", "true", "suffix")},
        {level("registered", "suffixes", "c.suffix = p.suffix", "suffix, domain")},
        {level("reputation", "registered", "c.suffix = p.suffix AND c.domain = p.domain", "suffix, domain, host")}
        SELECT page_id, j.host, path, {text} AS rule,
               coalesce({verdict}, CASE WHEN mean + 1.645 * sqrt(a * b / (pow(a + b, 2) * (a + b + 1))) < 0.5 THEN 'block' ELSE 'allow' END) AS verdict,
               coalesce(n, 0)::BIGINT AS host_labelled, coalesce(good, 0)::BIGINT AS host_good
        FROM (SELECT * FROM judged) j LEFT JOIN (SELECT host AS h, n, good, a, b, mean FROM reputation) r ON r.h = j.host"""


@query("op1_license_scan", _licence_sql())
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with at least one known licence sentence: its identifiers, licences, rules and left-over identifiers."""
    found = licences.scan_licences(table(spark, sf_dir, "documents", "doc_id", "text"))
    joined = [F.array_join(c, ",").alias(c) for c in ("sentence_ids", "licences", "licence_rules", "unmatched")]
    return found.where(F.size("sentence_ids") > 0).select("doc_id", *joined)


@query("op4_sentencepiece")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text as a digest, and whether decoding gives the text back."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return pieces.piece_digest(docs, public_tokenizers.path("piece_bpe_32k.model"))


@query("op6_url_filter", _url_sql())
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page url. Labelled outcomes: the quality label of the document that a path's number names."""
    urls_ = table(spark, sf_dir, "pages", "page_id", "url")
    labels = table(spark, sf_dir, "labels", "doc_id", "quality")
    number = F.regexp_extract(urls.url_path(F.col("url")), r"^/[^/]*/(\d{1,18})", 1).try_cast("long")
    outcomes = urls_.select("url", number.alias("doc_id")).where("doc_id IS NOT NULL").join(labels, "doc_id").select("url", F.col("quality").alias("good"))
    return urls.filter_urls(urls_, outcomes, urls.rules_from(URL_RULES)).select("page_id", "host", "path", "rule", "verdict", "host_labelled", "host_good")


@query("op2_edit_fingerprint")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every whole text and of its edited text, and their likeness."""
    return edit_prints.edited_prints(table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op8_best_fit_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as pieces of at most 2048 ids, and the sequence and place of each piece."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=2048)


@query("op5_quality_classifier")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every whole text, learned from labels of documents that are not held out."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = quality.fit_quality(docs, quality.learnable(table(spark, sf_dir, "labels", "doc_id", "quality")))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    scored = quality.score_quality(docs, model, keep=["doc_id"])
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op9_quality_rules")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every whole text, the base rules, and the verdict of the robust distance per language and source."""
    judged = rules.judge_quality(table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *counts, "base_failed", "kept", F.round("distance", 3).alias("distance"))


@query("op10_html_extraction")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return pages.extract_pages(table(spark, sf_dir, "pages", "page_id", "url", "html"))


@query("op3_minhash_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents by 4-word shingles at 0.8."""
    return minhash.near_components(table(spark, sf_dir, "documents", "doc_id", "text"), width=4, percent=80)


@query("op7_line_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its lines and the text that is left when one line of each component stays."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    # a line from "!" on begins with a character that is no white space; others are searched for one
    lines = F.size(F.filter(F.split("text", "\n"), lambda line: (line >= "!") | line.rlike(r"[^\x20\x09-\x0D]")))
    return fuzzy_lines.dedup_lines(docs.withColumn("n_lines", lines)).withColumn("n_kept", lines)


# Every order of the filters, applied to each mask: the step that removes it is the least place of a filter it fails.
_AUDIT_SQL = r"""
    WITH docs AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
    own AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
            FROM labels GROUP BY doc_id),
    words AS (SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws, min(doc_id) OVER (PARTITION BY t) AS first
              FROM docs),
    flags AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
                     [len(ws) < 100, 100 * len(list_distinct(ws)) < 80 * len(ws),
                      100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t),
                      regexp_matches(t, '[#$%&*|]'), coalesce(first < doc_id, false)] AS fails
              FROM words LEFT JOIN own USING (doc_id)),
    masks AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM flags GROUP BY ALL),
    f(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
    orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS o FROM f a, f b, f c, f d, f e
               WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
    gone AS (SELECT part, o, fails, n, good, toxic,
                    list_min([CASE WHEN fails[i] THEN instr(o, 'ABCDE'[i]) ELSE 6 END for i in [1, 2, 3, 4, 5]]) AS hit
             FROM masks, orders),
    steps AS (SELECT part, o, step, o[step] AS x, n, good, toxic, fails, hit, fails[instr('ABCDE', o[step])] AS own
              FROM gone, (VALUES (1), (2), (3), (4), (5)) s(step)),
    sums AS (SELECT part, o AS filter_order, step, x,
                    sum(CASE WHEN hit > step THEN n ELSE 0 END) AS kept,
                    sum(CASE WHEN hit = step THEN n ELSE 0 END) AS removed,
                    sum(CASE WHEN own AND hit < step THEN n ELSE 0 END) AS redundant,
                    sum(CASE WHEN own AND len(list_filter(fails, lambda y: y)) = 1 THEN n ELSE 0 END) AS unique_fails,
                    sum(CASE WHEN hit = step THEN good ELSE 0 END) AS good_lost,
                    sum(CASE WHEN hit = step THEN toxic ELSE 0 END) AS toxic_lost
             FROM steps GROUP BY ALL)
    SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
           CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
           CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
    FROM sums"""


@query("op13_filter_audit", _AUDIT_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes, in all 120 orders, per language."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    counts = filter_audit.mask_counts(docs, table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))
    return filter_audit.audit_filters(counts)


def shared_starts(conversations: DataFrame, family: int = 5, most: int = 9) -> DataFrame:
    """Sequences of turns in which the first crc32(id) % `most` turns come from the first conversation of the family."""
    own = prefix_trie.turn_sequences(conversations)
    own = own.withColumn("h", (F.crc32(F.col("id").cast("string")) % most).cast("int")).withColumn("base", F.col("id") - F.col("id") % family)
    first = own.where("id = base").select("base", *(F.slice(c, 1, most - 1).alias(f"first_{c}") for c in ("keys", "sizes")))
    spliced = lambda c: F.concat(F.slice(F.coalesce(f"first_{c}", F.slice(c, 1, 0)), F.lit(1), F.col("h")), F.slice(c, F.col("h") + 1, F.size(c)))
    return own.join(first, "base", "left").select("id", *(spliced(c).alias(c) for c in ("keys", "sizes")))


# h is the CRC-32 of the decimal number; a node is known by the digests of its turns.
_TRIE_SQL = """
    WITH codes AS (SELECT list_transform(range(0, 256), lambda i: list_reduce(range(0, 8),
                       lambda a, _: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i)) AS codes),
    turns AS (SELECT conv_id AS c, turn, r, sha256(strlen(r) || ':' || r || t) AS k, strlen(t) AS b
              FROM (SELECT *, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL)),
    own AS (SELECT c, list({'k': k, 'b': b} ORDER BY turn NULLS FIRST, r, k) AS s FROM turns GROUP BY c),
    lengths AS (SELECT own.*, xor(list_reduce(list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
                    lambda a, x: xor(a >> 8, codes[(xor(a, x) & 255) + 1]), 4294967295), 4294967295) % 9 AS h FROM own, codes),
    built AS (SELECT l.c, list_concat(coalesce(p.s[1:l.h], []), l.s[l.h + 1:]) AS s
              FROM lengths l LEFT JOIN own p ON p.c = l.c - l.c % 5),
    pre AS (SELECT c, d, len(s) AS n, CASE WHEN d > 0 THEN s[d].b ELSE 0 END AS b, array_to_string(list_transform(s[1:d], lambda e: e.k), '') AS p
            FROM (SELECT *, unnest(range(0, len(s) + 1)) AS d FROM built)),
    nodes AS (SELECT p, d, min(c) AS conv_id, count(*) AS n_convs, min(b) AS b,
                     sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (n = d), '')) AS ends_sha256 FROM pre GROUP BY p, d),
    up AS (SELECT v.p, u.p AS parent, u.conv_id AS parent_conv_id
           FROM nodes v JOIN pre ON pre.c = v.conv_id AND pre.d = v.d - 1 JOIN nodes u ON u.p = pre.p AND u.d = pre.d),
    kids AS (SELECT parent AS p, count(*) AS n_children FROM up GROUP BY parent),
    known AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children, parent_conv_id FROM nodes LEFT JOIN kids USING (p) LEFT JOIN up USING (p)),
    below AS (SELECT pre.p, pre.d, sum(CASE WHEN v.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((v.n_convs - 1) * v.b) AS saved_tokens
              FROM known v JOIN pre ON pre.c = v.conv_id AND pre.d <= v.d GROUP BY pre.p, pre.d)
    SELECT conv_id, d AS depth, parent_conv_id, n_convs, n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
           CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256 FROM known JOIN below USING (p, d)"""


@query("op12_prefix_trie", _TRIE_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of all conversations, each started with turns of the first of its family."""
    return prefix_trie.trie_nodes(shared_starts(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")))


@query("op11_toxicity")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every whole text, learned from labels of documents that are not held out."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = toxicity.fit_toxicity(docs, toxicity.learnable(table(spark, sf_dir, "labels", "doc_id", "toxic")))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    scored = toxicity.score_toxicity(docs, model, keep=["doc_id"])
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
