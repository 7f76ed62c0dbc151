"""The registered queries of this subpackage, one for each operator, and their oracle SQL.

Each query applies its operator with production parameters to its whole table and derives
the contract's columns from the operator's output.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.llm import (
    collocations,
    decontaminate,
    exact_dedup,
    language,
    licenses,
    mixing,
    near_dedup,
    packing,
    prefix_trie,
    sharding,
    substring,
    url_filter,
    warc,
)
from affinity.llm.common import table
from affinity.session import scratch_path

# Fixed values of the contracts.
NEAR_WORDS, NEAR_PERCENT = 3, 85
SHARDS = 40
WINDOW = 2048
RULES = (
    url_filter.Rule("block", "net", "/"),
    url_filter.Rule("allow", "example.net", "/en/"),
    url_filter.Rule("block", "example.com", "/de/"),
    url_filter.Rule("allow", "org", "/fr/"),
)
DAMPING, BLOCK_ABOVE = 0.85, 0.5
PAGERANK_PASSES = 10  # of the oracle SQL only, which unrolls them
MIX = mixing.Mix(weights=(3, 1, 2), share=(3, 2), repeats=2)
TOP_PHRASES, PHRASE_COUNT = 2000, 100
BASES, HEADS = 20, 4  # conversations that share a base; first turns taken from it: below HEADS


def default_tokenizer() -> tuple:
    """The installed public byte-level BPE: file, its vocabulary as ranks, split pattern."""
    import public_tokenizers

    return (
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


def language_model(docs: DataFrame) -> language.Model:
    return language.fit(docs.where(~language.held_out(F.col("doc_id"))))


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents"), NEAR_WORDS, NEAR_PERCENT)


def op2_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.predict(docs, language_model(docs))
    return found.select(
        "doc_id",
        language.held_out(F.col("doc_id")).alias("held_out"),
        "lang_pred",
        "score",
        F.concat_ws(",", "languages").alias("languages"),
    )


def op3_slot_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        "map_version",
    )


def op4_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_warc(table(spark, sf_dir, "pages"), path)
    return warc.archived_pages(warc.read_warc(spark, path, with_payload=False))


def op5_spaced_seed_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeated_passages(table(spark, sf_dir, "documents"))


def op7_license_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = F.broadcast(licenses.known_digests(spark))  # as many rows as known_texts() at most
    return licenses.scan_licenses(table(spark, sf_dir, "documents"), known)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.exact_groups(table(spark, sf_dir, "documents"))
    return groups.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op9_bin_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(
        table(spark, sf_dir, "documents"), default_tokenizer(), WINDOW, carry_ids=False
    )
    return packed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op10_link_graph_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge_urls(
        table(spark, sf_dir, "pages"), RULES, damping=DAMPING, threshold=BLOCK_ABOVE
    )
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op11_hash_threshold_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"), MIX)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), TOP_PHRASES, PHRASE_COUNT)


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = prefix_trie.digested_turns(table(spark, sf_dir, "conversations"))
    conv = F.col("conv_id")
    head = F.crc32(conv.cast("string")) % HEADS
    return prefix_trie.prefix_trie(prefix_trie.rebuilt(convs, conv - conv % BASES, head, HEADS - 1))


def queries() -> dict:
    own = (
        op1_minhash_near_dedup,
        op2_language_mixture,
        op3_slot_sharding,
        op4_warc_salvage,
        op5_spaced_seed_overlaps,
        op6_repeated_passages,
        op7_license_digests,
        op8_exact_dedup,
        op9_bin_slack_packing,
        op10_link_graph_urls,
        op11_hash_threshold_mix,
        op12_phrase_collocations,
        op13_conversation_trie,
    )
    return {f.__name__: f for f in own}


# ---------------------------------------------------------------- oracle SQL

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _near_sql() -> str:
    lower = f"translate(text, '{_UPPER}', '{_UPPER.lower()}')"
    k = NEAR_WORDS
    return f"""WITH RECURSIVE w AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array({lower}, '[\\x20\\x09-\\x0D]+') IF x <> ''] AS ws FROM documents),
s AS (
  SELECT doc_id, CASE WHEN ws IS NULL OR len(ws) = 0 THEN [] WHEN len(ws) < {k} THEN [array_to_string(ws, ' ')]
    ELSE list_distinct([array_to_string(ws[i:i + {k - 1}], ' ') FOR i IN range(1, len(ws) - {k - 1} + 1)]) END AS sh
  FROM w),
n AS (SELECT doc_id, len(sh) AS n FROM s),
u AS (SELECT doc_id, unnest(sh) AS g FROM s),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM u a JOIN u b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id),
e AS (
  SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b
  WHERE 100 * common >= {NEAR_PERCENT} * (x.n + y.n - common)),
r AS (
  SELECT doc_id, doc_id AS reach FROM n
  UNION
  SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.reach),
c AS (SELECT doc_id, min(reach) AS component_id FROM r GROUP BY doc_id)
SELECT n.doc_id, n.n AS n_shingles, c.component_id, n.doc_id = c.component_id AS kept FROM n JOIN c USING (doc_id)"""


_EXACT_SQL = """SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))"""

_WARC_SQL = f"""WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, strlen(coalesce(html, '')) AS n FROM pages),
f AS (SELECT *, CASE WHEN n >= {warc.MIN_REVISIT_BYTES} THEN min(page_id) OVER (PARTITION BY h) ELSE page_id END AS first_id FROM p)
SELECT page_id, n AS payload_bytes, sha256(h) AS payload_digest,
  CASE WHEN page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > first_id THEN first_id END AS refers_to
FROM f"""


def _licenses_sql() -> str:
    def canon(x: str) -> str:
        pattern = licenses.COPYRIGHT_LINE.replace("(?im)", "")
        x = f"regexp_replace({x}, '{pattern}', '', 'gim')"
        x = f"' ' || regexp_replace(lower({x}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g') || ' '"
        for a, b in licenses.SPELLINGS:
            x = f"replace({x}, ' {a} ', ' {b} ')"
        return f"trim(regexp_replace({x}, ' +', ' ', 'g'))"

    known = ", ".join("(" + ", ".join("'" + v.replace("'", "''") + "'" for v in row) + ")" for row in licenses.known_texts())
    return f"""WITH k AS (
  SELECT {canon('t')} AS c, min(l) AS license, min(cl) AS license_class FROM (VALUES {known}) AS x(l, cl, t) GROUP BY 1),
u AS (
  SELECT doc_id, 'text' AS unit, text AS part FROM documents
  UNION ALL
  SELECT doc_id, 'line' AS unit, unnest(string_split(text, chr(10))) AS part FROM documents WHERE contains(text, chr(10)))
SELECT doc_id, unit, license, license_class, count(*) AS n
FROM (SELECT doc_id, unit, {canon('part')} AS c FROM u) JOIN k USING (c) WHERE c <> ''
GROUP BY doc_id, unit, license, license_class"""


def _urls_sql() -> str:
    host = f"coalesce(translate(regexp_extract({{}}, '^.*?://([^/?#]*)', 1, 's'), '{_UPPER}', '{_UPPER.lower()}'), '')"
    rule = verdict = "NULL"
    for r in sorted(RULES, key=lambda r: len(r.text)):
        fits = f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"
        rule = f"CASE WHEN {fits} THEN '{r.text}' ELSE {rule} END"
        verdict = f"CASE WHEN {fits} THEN '{r.verdict}' ELSE {verdict} END"

    def walk(name: str, seed: str, src: str, dst: str) -> str:
        steps = [f"{name}0 AS (SELECT host, {seed} AS r FROM h WHERE {seed} > 0)"]
        for i in range(1, PAGERANK_PASSES + 1):
            steps.append(
                f"{name}{i} AS (SELECT host, sum(p) AS r FROM (SELECT {dst} AS host, {DAMPING} * r * {name}s.share AS p "
                f"FROM {name}{i - 1} JOIN {name}s ON {name}{i - 1}.host = {name}s.{src} "
                f"UNION ALL SELECT host, r FROM {name}0) GROUP BY host)"
            )
        share = f"{name}s AS (SELECT src, dst, links / sum(links) OVER (PARTITION BY {src}) AS share FROM e)"
        return ",\n".join([share, *steps])

    link = url_filter.LINK.replace("(?i)", "").replace("'", "''")
    absolute = "CASE WHEN starts_with(l, '//') THEN 'http:' || l ELSE l END"
    last = PAGERANK_PASSES
    return f"""WITH a AS (
  SELECT page_id, {host.format('url')} AS host, coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path FROM pages),
j AS (SELECT *, {rule} AS rule, {verdict} AS ruled FROM a),
h AS (
  SELECT host, avg(CASE WHEN ruled = 'allow' THEN 1.0 ELSE 0.0 END) AS allowed,
    avg(CASE WHEN ruled = 'block' THEN 1.0 ELSE 0.0 END) AS blocked
  FROM j WHERE host <> '' GROUP BY host),
l AS (
  SELECT {host.format('url')} AS src, unnest(regexp_extract_all(html, '{link}', 1, 'i')) AS l FROM pages),
e AS (
  SELECT src, {host.format(absolute)} AS dst, count(*) AS links FROM l
  WHERE regexp_matches(l, '^([A-Za-z][A-Za-z0-9+.-]*:)?//') GROUP BY 1, 2 HAVING src <> '' AND dst <> '' AND src <> dst),
{walk('t', 'allowed', 'src', 'dst')},
{walk('d', 'blocked', 'dst', 'src')}
SELECT page_id, host, path, rule,
  coalesce(ruled, CASE WHEN coalesce(d{last}.r, 0) - coalesce(t{last}.r, 0) > {BLOCK_ABOVE} THEN 'block' ELSE 'allow' END) AS verdict
FROM j LEFT JOIN t{last} USING (host) LEFT JOIN d{last} USING (host)"""


_WORD_COUNT = "len(regexp_extract_all({}, '[^\\x20\\x09-\\x0D]+'))"


def _mix_sql() -> str:
    """Targets in closed form: by falling weight per word, sources are capped until the first
    one whose share of the rest fits."""
    num, den = MIX.share
    step = math.lcm(*MIX.weights)
    return f"""WITH d AS (
  SELECT doc_id, source, {_WORD_COUNT.format("coalesce(text, '')")} AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15) AS BIGINT) AS h
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS HUGEINT) AS n,
    list_extract({list(MIX.weights)}, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(MIX.weights)} + 1 AS INTEGER)) AS w
  FROM d GROUP BY source),
o AS (SELECT *, row_number() OVER (ORDER BY n * ({step} // w), source NULLS LAST) AS i FROM s),
c AS (
  SELECT i, {num} * (SELECT sum(n) FROM s) - {den} * coalesce(sum({MIX.repeats} * n) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS words,
    {den} * sum(w) OVER (ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS parts, w, n FROM o),
f AS (SELECT words, parts, i FROM c WHERE w * words <= {MIX.repeats} * n * parts ORDER BY i LIMIT 1),
t AS (
  SELECT source, n, CASE WHEN o.i < f.i THEN CAST({MIX.repeats} * n AS DOUBLE) ELSE CAST(w * words AS DOUBLE) / CAST(parts AS DOUBLE) END AS target,
    CASE WHEN o.i < f.i THEN {MIX.repeats} * n ELSE (w * words) // parts END AS budget FROM o, f),
p AS (SELECT *, CASE WHEN n > 0 THEN budget // n ELSE 0 END AS passes, CASE WHEN n > 0 THEN budget % n ELSE 0 END AS rest FROM t),
r AS (
  SELECT d.*, p.n, p.target, p.passes, p.rest,
    sum(size) OVER (PARTITION BY d.source ORDER BY h RANGE UNBOUNDED PRECEDING) AS upto,
    sum(size) OVER (PARTITION BY d.source, h) AS here
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, CAST(n AS BIGINT) AS source_size, target,
  CAST(size * passes + CASE WHEN upto <= rest THEN size WHEN upto - here <= rest AND here > 0 THEN size * (rest - (upto - here)) // here ELSE 0 END AS BIGINT) AS taken
FROM r"""


def _phrases_sql() -> str:
    most = collocations.MAX_WORDS
    lower = f"translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')"
    grams = "\nUNION ALL\n".join(
        f"SELECT lang, unnest([array_to_string(ws[i:i + {j - 1}], ' ') FOR i IN range(1, len(ws) - {j - 2})]) AS p, {j} AS len FROM w"
        for j in range(1, most + 1)
    )
    return f"""WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({lower}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, [x FOR x IN regexp_split_to_array(piece, '[\\x20\\x09]+') IF x <> ''] AS ws FROM pieces),
every AS (SELECT lang, p, len, count(*) AS f FROM ({grams}) GROUP BY ALL),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM every WHERE len = 1 GROUP BY lang),
g AS (SELECT *, string_split(p, ' ') AS ws FROM every WHERE f >= {PHRASE_COUNT}),
cut AS (SELECT *, unnest(range(1, len)) AS k FROM g WHERE len > 1),
scored AS (
  SELECT c.lang, c.p, c.len, c.f AS a, k, x.f AS l, y.f AS r, n,
    (CAST(1000 AS HUGEINT) * c.f * n) // (CAST(x.f AS HUGEINT) * y.f) AS score
  FROM cut c JOIN total USING (lang)
    JOIN g x ON x.lang = c.lang AND x.p = array_to_string(c.ws[1:k], ' ')
    JOIN g y ON y.lang = c.lang AND y.p = array_to_string(c.ws[k + 1:], ' ')),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
inside AS (
  SELECT lang, f, unnest([array_to_string(ws[2:], ' '), array_to_string(ws[:-2], ' ')]) AS p FROM g WHERE len > 2),
kept AS (
  SELECT * FROM lowest s WHERE NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = s.lang AND i.p = s.p AND 100 * i.f >= 100 * s.a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank FROM kept)
SELECT lang, rank, p AS phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= {TOP_PHRASES}"""


def _crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit."""
    bits = "[0, 0, 0, 0, 0, 0, 0, 0]"
    poly = 0xEDB88320  # fixed value: the polynomial of CRC-32
    step = f"list_reduce(list_concat([xor(c, b)], {bits}), lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, {poly}) ELSE v >> 1 END)"
    codes = f"[CAST(ascii(x) AS BIGINT) FOR x IN string_split({text}, '')]"
    start = 0xFFFFFFFF
    return f"xor(list_reduce(list_concat([CAST({start} AS BIGINT)], {codes}), lambda c, b: {step}), {start})"


def _trie_sql() -> str:
    text, role = "coalesce(text, '')", "coalesce(role, '')"
    return f"""WITH t AS (
  SELECT conv_id, turn, md5(CAST(length({role}) AS VARCHAR) || ':' || {role} || {text}) AS id, {_WORD_COUNT.format(text)} AS words
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list({{'id': id, 'words': words}} ORDER BY turn NULLS FIRST, id) AS turns FROM t GROUP BY conv_id),
h AS (SELECT *, {_crc32_sql('CAST(conv_id AS VARCHAR)')} % {HEADS} AS h FROM c),
b AS (
  SELECT h.conv_id, list_concat(coalesce(x.turns, [])[1:h], h.turns[h + 1:]) AS turns
  FROM h LEFT JOIN c x ON x.conv_id = h.conv_id - h.conv_id % {BASES}),
m AS (
  SELECT conv_id, d AS depth, [x.id FOR x IN turns[1:d]] AS prefix, CASE WHEN d > 0 THEN turns[d].words ELSE 0 END AS words, len(turns) AS size
  FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM b)),
n AS (
  SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (size = depth), '')) AS ends_sha256
  FROM m GROUP BY prefix, depth),
k AS (SELECT prefix[1:depth - 1] AS prefix, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
v AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (prefix)),
s AS (
  SELECT up, CAST(sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves, CAST(sum((n_convs - 1) * words) AS BIGINT) AS saved_tokens
  FROM (SELECT *, unnest([prefix[1:d] FOR d IN range(0, depth + 1)]) AS up FROM v) GROUP BY up)
SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children, s.n_leaves, s.saved_tokens, v.ends_sha256
FROM v JOIN s ON s.up = v.prefix LEFT JOIN n p ON v.depth > 0 AND p.prefix = v.prefix[1:v.depth - 1]"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_minhash_near_dedup": _near_sql(),
        "op4_warc_salvage": _WARC_SQL,
        "op7_license_digests": _licenses_sql(),
        "op8_exact_dedup": _EXACT_SQL,
        "op10_link_graph_urls": _urls_sql(),
        "op11_hash_threshold_mix": _mix_sql(),
        "op12_phrase_collocations": _phrases_sql(),
        "op13_conversation_trie": _trie_sql(),
    }
