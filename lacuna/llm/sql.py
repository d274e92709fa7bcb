"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from lacuna.llm.chat import CONTROL_TAILS
from lacuna.llm.common import LOWER, SPACE, UPPER, WORD
from lacuna.llm.hilbert import curve_cells

WORDS = f"list_filter(regexp_split_to_array(coalesce(text, ''), '{SPACE}'), lambda x: x <> '')"


def url_filters(depth: int = 6) -> str:
    """The template tree level by level, for paths of fewer than ``depth`` segments."""
    segs = [f"s{i}" for i in range(1, depth + 1)]
    cols = ", ".join(segs)
    rules = [("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"),
             ("com", "/de/", "block"), ("org", "/", "allow")]  # longest first
    case = [(f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", h + p, v) for h, p, v in rules]
    rule = "CASE " + " ".join(f"WHEN {c} THEN '{r}'" for c, r, _ in case) + " END"
    verdict = "CASE " + " ".join(f"WHEN {c} THEN '{v}'" for c, _, v in case) + " END"
    five = "5.0::DOUBLE"

    def differ(pl, pb, ln, bn):
        d = f"({bn} * {pl} - {pb} * {ln})"
        return f"{d} * {d} * ({pl} + {ln}) > 4.0::DOUBLE * ({pb} + {bn}) * ({pl} + {ln} - {pb} - {bn}) * {pl} * {ln}"

    # a sibling as a state of the fold over siblings: its own counts are the last ones, its branch is empty
    apart = (f"({differ('a.pl', 'a.pb', 'x.pl', 'x.pb')}) OR (x.pl >= 30 AND a.l >= 30 AND ({differ('a.l', 'a.b', 'x.pl', 'x.pb')}))")
    fold = (f"list_reduce(e, lambda a, x: {{'rate': x.rate, 'pl': x.pl, 'pb': x.pb, 'c': x.c, "
            f"'l': CASE WHEN {apart} THEN 0.0::DOUBLE ELSE a.l END + x.pl * x.c, 'b': CASE WHEN {apart} THEN 0.0::DOUBLE ELSE a.b END + x.pb * x.c, "
            f"'starts': CASE WHEN {apart} THEN list_append(a.starts, {{'rate': x.rate, 'l': x.pl, 'b': x.pb}}) ELSE a.starts END}}, "
            "{'rate': 0.0::DOUBLE, 'pl': 0.0::DOUBLE, 'pb': 0.0::DOUBLE, 'c': 0.0::DOUBLE, 'l': 0.0::DOUBLE, 'b': 0.0::DOUBLE, 'starts': e[1].starts})")
    none = "CAST([] AS STRUCT(rate DOUBLE, l DOUBLE, b DOUBLE)[])"
    every = f"{cols}, host, n, labelled, bad, node, name, ended, up_n, up_rate"
    steps, tree = [], "tree0"
    for k, seg in enumerate(segs, 1):
        own = "(kn >= up_n * 0.05::DOUBLE OR kl >= 3 OR kn >= sqrt(up_n))"
        escaped = rf"regexp_replace({seg}, '([\\|*])', '\\\1', 'g')"
        steps.append(f"""
kids{k} AS (
  SELECT *, CASE WHEN {seg} = '' OR (kn >= 3 AND {own} AND regexp_matches({seg}, '[^0-9]')) THEN {escaped} ELSE '*' END AS t
  FROM (SELECT host, node, {seg}, sum(n) AS kn, sum(labelled) AS kl, sum(bad) AS kb, any_value(up_n) AS up_n, any_value(up_rate) AS up_rate
        FROM {tree} WHERE NOT ended GROUP BY host, node, {seg})),
sib{k} AS (
  SELECT *, (b + {five} * up_rate) / (l + {five}) AS rate
  FROM (SELECT host, node, t, sum(kn) AS n, sum(kl)::DOUBLE AS l, sum(kb)::DOUBLE AS b, any_value(up_rate) AS up_rate
        FROM kids{k} GROUP BY host, node, t)),
lists{k} AS (
  SELECT host, node, list({{'rate': rate, 'pl': l, 'pb': b, 'c': c, 'l': 0.0::DOUBLE, 'b': 0.0::DOUBLE, 'starts': {none}}} ORDER BY rate, l, b) AS e
  FROM (SELECT host, node, rate, l, b, count(*)::DOUBLE AS c FROM sib{k} WHERE l > 0 GROUP BY host, node, rate, l, b) GROUP BY host, node),
starts{k} AS (SELECT host, node, ({fold}).starts AS starts FROM lists{k}),
cut{k} AS (
  SELECT s.*, len(list_filter(coalesce(starts, {none}), lambda x: x <= {{'rate': rate, 'l': l, 'b': b}})) AS branch
  FROM sib{k} s LEFT JOIN starts{k} USING (host, node)),
merged{k} AS (
  SELECT host, node, branch, sum(n) AS m_n, (sum(b) + {five} * any_value(up_rate)) / (sum(l) + {five}) AS m_rate,
         CASE WHEN count(*) <= 64 THEN string_agg(t, '|' ORDER BY t) ELSE min(t) || '|+' || (count(*) - 1) END AS names
  FROM cut{k} GROUP BY host, node, branch),
tree{k} AS (
  SELECT {every} FROM {tree} WHERE ended UNION ALL
  SELECT {', '.join('f.' + s for s in segs)}, f.host, f.n, f.labelled, f.bad, f.node || '/' || m.branch AS node,
         f.name || '/' || m.names AS name, f.{seg} = '' AS ended, m.m_n AS up_n, m.m_rate AS up_rate
  FROM {tree} f JOIN kids{k} c ON c.host = f.host AND c.node = f.node AND c.{seg} = f.{seg}
  JOIN cut{k} u ON u.host = c.host AND u.node = c.node AND u.t = c.t
  JOIN merged{k} m ON m.host = u.host AND m.node = u.node AND m.branch = u.branch WHERE NOT f.ended)""")
        tree = f"tree{k}"
    seg_of = ", ".join(f"coalesce(list_filter(string_split(path, '/'), lambda x: x <> '')[{i}], '') AS s{i}" for i in range(1, depth + 1))
    return rf"""
WITH cut0 AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
hosts AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*', 0) AS raw FROM cut0),
urls AS (
  SELECT page_id, translate(raw, '{UPPER}', '{LOWER}') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*', 0) AS path FROM hosts),
worst AS (
  SELECT doc_id, max(CASE WHEN toxic = 1 OR quality = 0 THEN 1 ELSE 0 END) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
rows AS (
  SELECT page_id, host, path, bad, {seg_of}
  FROM urls LEFT JOIN worst ON TRY_CAST(regexp_extract(path, '([0-9]+)(\.html)?/?$', 1) AS BIGINT) = doc_id),
leaf AS (SELECT host, {cols}, count(*) AS n, count(bad) AS labelled, coalesce(sum(bad), 0) AS bad FROM rows GROUP BY host, {cols}),
top AS (SELECT coalesce(sum(bad)::DOUBLE / nullif(sum(labelled), 0)::DOUBLE, 0.0::DOUBLE) AS top FROM leaf),
host_n AS (SELECT host, sum(labelled)::DOUBLE AS hl, sum(bad)::DOUBLE AS hb, sum(n) AS up_n FROM leaf GROUP BY host),
tree0 AS (
  SELECT {', '.join('leaf.' + s for s in segs)}, host, n, labelled, bad, '' AS node, '' AS name, false AS ended, up_n, (hb + {five} * top) / (hl + {five}) AS up_rate FROM leaf JOIN host_n USING (host), top),
{','.join(steps)}
SELECT page_id, r.host, path, {rule.replace('host', 'r.host')} AS rule,
       coalesce({verdict.replace('host', 'r.host')}, CASE WHEN 1.0::DOUBLE - up_rate < 0.5::DOUBLE THEN 'block' ELSE 'allow' END) AS verdict,
       t.name AS template, t.up_rate AS bad_rate
FROM rows r JOIN {tree} t ON t.host = r.host AND {' AND '.join(f't.{s} = r.{s}' for s in segs)}"""


MIXING = f"""
WITH d AS (
  SELECT doc_id, source, len({WORDS})::BIGINT AS size,
         ('0x' || substr(md5('7|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS h
  FROM documents),
s AS (
  SELECT source, sum(size)::HUGEINT AS ss, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) + 1]::HUGEINT AS w
  FROM d GROUP BY source),
o AS (
  SELECT *, row_number() OVER byr - 1 AS k, sum(ss) OVER () AS total,
         coalesce(sum(ss) OVER (byr ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c,
         sum(w) OVER (byr ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS wr
  FROM s WINDOW byr AS (ORDER BY ss::DOUBLE / w, source NULLS LAST)),
f AS (SELECT k, 3 * total - 4 * c AS top, 2 * wr AS bottom FROM o WHERE w * (3 * total - 4 * c) <= 2 * ss * 2 * wr ORDER BY k LIMIT 1),
t AS (
  SELECT source, ss, CASE WHEN f.k IS NULL OR o.k < f.k THEN (2 * ss)::DOUBLE ELSE (w * top)::DOUBLE / bottom::DOUBLE END AS target,
         CASE WHEN f.k IS NULL OR o.k < f.k THEN 2 * ss ELSE w * top // bottom END AS budget
  FROM o LEFT JOIN f ON true),
p AS (
  SELECT d.*, t.ss, t.target, CASE WHEN ss > 0 THEN budget // ss ELSE 0 END AS copies,
         CASE WHEN ss > 0 THEN budget - (budget // ss) * ss ELSE 0 END AS rest
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
r AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run,
         sum(size) OVER (PARTITION BY source, h) AS tie FROM p)
SELECT doc_id, size, ss::BIGINT AS source_size, target,
       (CASE WHEN size = 0 THEN 0 ELSE copies * size + CASE WHEN run <= rest THEN size WHEN run - tie <= rest
          THEN size * (rest - run + tie) // tie ELSE 0 END END)::BIGINT AS taken
FROM r"""


def _numbers(column: str) -> str:
    """Numbers that touch no letter as one character, which is no digit; twice, as neighbours share a separator."""
    for _ in range(2):
        column = rf"regexp_replace({column}, '(^|[^\p{{L}}0-9])[0-9]+([^\p{{L}}0-9]|$)', '\1' || chr(1) || '\2', 'g')"
    return column


QUALITY = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, text, {WORDS} AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS ls FROM documents),
grams AS (
  SELECT rid, i, list_slice(ws, i, i + 4) AS g FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM d WHERE len(ws) >= 5)),
twice AS (SELECT rid, g FROM grams GROUP BY rid, g HAVING count(*) > 1),
hit AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM grams JOIN twice USING (rid, g), (SELECT unnest(range(0, 5)) AS k) GROUP BY rid),
keyed AS (
  SELECT rid, source, text, translate({_numbers(f"trim(regexp_replace(l, '{SPACE}', ' ', 'g'))")}, '{UPPER}', '{LOWER}') AS line
  FROM (SELECT rid, source, text, unnest(ls) AS l FROM d)),
short AS (SELECT *, length(line) - length(replace(line, ' ', '')) + 1 AS w FROM keyed),
held AS (SELECT source, line, count(DISTINCT text) AS n FROM short GROUP BY source, line),
hosts AS (SELECT source, count(DISTINCT coalesce(md5(text), '~')) AS texts FROM documents GROUP BY source),
often AS (
  SELECT held.source, line FROM held JOIN hosts ON held.source IS NOT DISTINCT FROM hosts.source
  WHERE n >= 20 AND n >= texts * 0.02::DOUBLE),
gone AS (
  SELECT rid, sum(w) AS gone FROM short JOIN often ON short.source IS NOT DISTINCT FROM often.source AND short.line = often.line
  GROUP BY rid),
m AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
         (length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(hit.n, 0)::BIGINT AS n_repeat_words, coalesce(gone, 0) AS gone
  FROM d LEFT JOIN hit USING (rid) LEFT JOIN gone USING (rid)),
v AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (gone > 0 AND (n_words - gone < 10 OR n_words - gone < n_words * 0.3::DOUBLE)) AS kept
FROM v"""


def _escape(column: str) -> str:
    tails = "|".join(t.replace("|", r"\|").replace("[", r"\[").replace("]", r"\]") for t in CONTROL_TAILS)
    return rf"regexp_replace({column}, '([<\[])(\\*)({tails})', '\1\\\2\3', 'g')"


CHAT = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
said AS (
  SELECT *, length({_escape('text')}) + length({_escape(r"replace(replace(role, '\', '\\'), chr(10), '\n')")})
            + length('<|im_start|>') + length('<|im_end|>') + 2 AS shown FROM turns)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(shown)::BIGINT AS formatted_chars
FROM said GROUP BY conv_id"""


TOPK = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 20"""


SUBSTRING = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {WORDS} AS ws FROM documents),
w AS (
  SELECT rid, i, array_to_string(list_slice(ws, i, i + 34), ' ') AS g
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 33)) AS i FROM d WHERE len(ws) >= 35)),
twice AS (SELECT g FROM w GROUP BY g HAVING count(*) > 1),
hit AS (SELECT DISTINCT rid, i + k AS p FROM w JOIN twice USING (g), (SELECT unnest(range(0, 35)) AS k)),
word AS (SELECT rid, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS p FROM d),
kept AS (SELECT rid, string_agg(x, ' ' ORDER BY p) AS t FROM word ANTI JOIN hit USING (rid, p) GROUP BY rid),
gone AS (SELECT rid, count(*) AS n FROM hit GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid) LEFT JOIN gone USING (rid)"""


#: the CRC32 table, from its rule: eight conditional shifts of each byte
CRC_TABLE = """tab AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i::BIGINT, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                          lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c FROM range(256) r(i)))"""


def crc32(codes: str) -> str:
    """CRC32 of a list of byte values, folded over ``t`` of CRC_TABLE."""
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda a, y: xor(a >> 8, t[(xor(a, y) & 255) + 1])), 4294967295)"


def sharding() -> str:
    cells = ", ".join(f"({c},{h})" for c, h in curve_cells())
    return f"""
WITH {CRC_TABLE},
b AS (SELECT doc_id, lang, coalesce(text, '') AS text, hex(encode(coalesce(text, ''))) AS x FROM documents),
l AS (
  SELECT doc_id, lang, (length(x) // 2 + 1)::BIGINT AS size, length(text) - length(replace(text, chr(10), '')) + 1 AS lines,
         list_transform(range(0, length(x) // 2), lambda i: ('0x' || x[2 * i + 1:2 * i + 2])::BIGINT) AS v FROM b),
d AS (
  SELECT doc_id, size, {crc32('v')} AS crc,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS idh,
         step * 256 + least(15, greatest(0, length(bin(size)) - 4)) * 16
         + least(15, greatest(0, length(bin(lines)) - 1)) AS cell
  FROM l JOIN (SELECT lang AS name, CASE WHEN count(*) OVER () <= 16 THEN k ELSE k * 16 // count(*) OVER () END AS step
               FROM (SELECT lang, row_number() OVER (ORDER BY lang NULLS LAST) - 1 AS k FROM (SELECT DISTINCT lang FROM documents)))
         ON name IS NOT DISTINCT FROM lang, tab),
n AS (SELECT count(*) AS n FROM documents),
k AS (SELECT n, (SELECT min(s) FROM (SELECT 32 * (1::BIGINT << i) AS s FROM range(0, 40) g(i)) z WHERE n <= 3 * s * 4096) AS salts FROM n),
r AS (
  SELECT d.*, n, row_number() OVER (ORDER BY h, crc, idh % salts, idh, doc_id NULLS FIRST, size) - 1 AS rank
  FROM d JOIN (VALUES {cells}) c(cell, h) USING (cell), k),
s AS (SELECT *, rank * 8 // n AS shard FROM r)
SELECT doc_id, size, crc AS text_crc32, 'rows' AS law, shard::INTEGER AS shard, (rank - (shard * n + 7) // 8)::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM s"""


BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
WARC = f"""
WITH p AS (SELECT row_number() OVER () AS rid, page_id, coalesce(html, '') AS x FROM pages),
r AS (SELECT *, sha1(x) AS h, row_number() OVER same AS k, first_value(page_id) OVER same AS top
      FROM p WINDOW same AS (PARTITION BY x ORDER BY page_id DESC NULLS LAST, rid))
SELECT page_id, strlen(x)::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i:
         '{BASE32}'[((('0x' || h[(i * 5) // 4 + 1:(i * 5) // 4 + 2])::BIGINT >> (3 - (i * 5) % 4)) & 31) + 1]), '') AS payload_digest,
       CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN k > 1 THEN top END AS refers_to, 'ok' AS status
FROM r"""


#: a node's members share a list of turn digests; a node's ancestors are the prefixes of its smallest member
TRIE = f"""
WITH {CRC_TABLE},
turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS x, len({WORDS}) AS w FROM conversations WHERE conv_id IS NOT NULL),
l AS (
  SELECT conv_id, list(md5(length(role) || '|' || role || x) ORDER BY turn NULLS FIRST, role, md5(x)) AS d,
         list(w ORDER BY turn NULLS FIRST, role, md5(x)) AS w FROM turns GROUP BY conv_id),
c AS (
  SELECT l.*, {crc32("list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: ascii((conv_id::VARCHAR)[i])::BIGINT)")} % 4 AS h FROM l, tab),
r AS (
  SELECT c.conv_id, list_concat(coalesce(b.d, [])[1:h], c.d[h + 1:]) AS d, list_concat(coalesce(b.w, [])[1:h], c.w[h + 1:]) AS w
  FROM c LEFT JOIN l b ON b.conv_id = c.conv_id - c.conv_id % 20),
p AS (
  SELECT conv_id, k AS depth, md5(coalesce(array_to_string(d[1:k], ','), '')) AS node,
         CASE WHEN k > 0 THEN md5(coalesce(array_to_string(d[1:k - 1], ','), '')) END AS parent,
         CASE WHEN k > 0 THEN w[k] ELSE 0 END AS w, k = len(d) AS ends
  FROM (SELECT *, unnest(range(0, len(d) + 1)) AS k FROM r)),
n AS (
  SELECT node, any_value(parent) AS parent, any_value(depth) AS depth, min(conv_id) AS conv, count(*) AS n, any_value(w) AS w,
         string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends) AS ids FROM p GROUP BY node),
kids AS (SELECT parent AS node, count(*) AS kids FROM n WHERE parent IS NOT NULL GROUP BY parent),
under AS (
  SELECT p.node, count(*) FILTER (kids IS NULL) AS leaves, sum((n.n - 1) * n.w) AS saved
  FROM n LEFT JOIN kids USING (node) JOIN p ON p.conv_id = n.conv AND p.depth <= n.depth GROUP BY p.node)
SELECT n.conv AS conv_id, n.depth::BIGINT AS depth, up.conv AS parent_conv_id, n.n::BIGINT AS n_convs, coalesce(kids, 0)::BIGINT AS n_children,
       leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, sha256(coalesce(n.ids, '')) AS ends_sha256
FROM n LEFT JOIN n up ON up.node = n.parent LEFT JOIN kids ON kids.node = n.node JOIN under ON under.node = n.node"""


NEGATIVES = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS alike, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND (a.vec_id <> b.vec_id OR a.label <> b.label)),
p AS (SELECT * FROM s WHERE alike QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5),
n AS (
  SELECT p.a AS anchor_id, p.b AS positive_id, s.b AS negative_id, p.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) AS rank
  FROM p JOIN s ON s.a = p.a AND NOT s.alike AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3"""


ORACLES: dict[str, str] = {
    "op2_url_filters": url_filters(),
    "op3_mixing": MIXING,
    "op5_topk": TOPK,
    "op6_quality": QUALITY,
    "op8_substring": SUBSTRING,
    "op9_sharding": sharding(),
    "op10_chat": CHAT,
    "op11_warc": WARC,
    "op12_prefix_trie": TRIE,
    "op13_hard_negatives": NEGATIVES,
}
