"""DuckDB SQL for the corpus operators that SQL can express."""

from __future__ import annotations

from textmill.llm import divergence_audit as D
from textmill.llm import license_scan as L
from textmill.llm import quality_rules as Q
from textmill.llm import secret_scan as S
from textmill.llm import vector_codes as V
from textmill.llm.common import LOWER, UPPER
from textmill.llm.line_dedup import MIN_CHARS, MIN_DOCS
from textmill.llm.substring_dedup import SIZE

_SPACE = r"[\x20\x09-\x0D]"
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _slices(k: int) -> str:
    """The words of all ``k``-word windows, a column each: no window row carries the text."""
    return ", ".join(f"unnest(w[{j + 1}:len(w) - {k - 1 - j}]) AS a{j}" for j in range(k))


SUBSTRING_DEDUP = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
starts AS (SELECT doc_id, unnest(range(1, len(w) - {SIZE} + 2)) AS i, {_slices(SIZE)} FROM d WHERE len(w) >= {SIZE}),
windows AS (SELECT doc_id, i, concat_ws(' ', {', '.join(f'a{k}' for k in range(SIZE))}) AS g FROM starts),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS rn FROM windows) WHERE rn > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {SIZE})) AS pos FROM later),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM d),
marked AS (SELECT words.doc_id, word, words.pos, gone.pos IS NOT NULL AS cut FROM words LEFT JOIN gone USING (doc_id, pos)),
kept AS (SELECT doc_id, count(*) FILTER (WHERE cut) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (WHERE NOT cut) AS k FROM marked GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

LINE_DEDUP = f"""
WITH s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM s),
k AS (SELECT *, translate(regexp_replace(line, '^{_SPACE}+|{_SPACE}+$', '', 'g'), '{UPPER}', '{LOWER}') AS key FROM l),
dup AS (SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= {MIN_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
m AS (SELECT k.*, dup.top IS NOT NULL AND dup.top <> doc_id AS cut FROM k LEFT JOIN dup USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (WHERE cut))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT cut), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


def _quality_rules() -> str:
    def fences(name: str, keys: str) -> str:
        part = f"{keys}, metric" if keys else "metric"
        lead = f"{keys}, " if keys else ""
        at = lambda p: f"min(bucket) FILTER (WHERE 100 * cum >= {p} * total)"
        res = "CASE metric " + " ".join(f"WHEN '{m}' THEN {v}" for m, v in Q.RESOLUTION.items()) + " END"
        pick = ", ".join([f"max(hi) FILTER (WHERE metric = '{m}') AS {m}_hi" for m in Q.RESOLUTION]
                         + [f"max(lo) FILTER (WHERE metric = '{m}') AS {m}_lo" for m in Q.TWO_SIDED])
        return f"""
{name}_m AS (SELECT {lead}metric, bucket, sum(n) AS n FROM sketch GROUP BY {part}, bucket),
{name}_c AS (SELECT *, sum(n) OVER (PARTITION BY {part} ORDER BY bucket) AS cum, sum(n) OVER (PARTITION BY {part}) AS total FROM {name}_m),
{name}_q AS (SELECT {lead}metric, {at(25)} AS q25, {at(50)} AS q50, {at(75)} AS q75, max(total) AS total FROM {name}_c GROUP BY {part}),
{name}_f AS (SELECT *, q50 + {Q.REACH} * greatest(q75 - q50, {res}) AS hi, q50 - {Q.REACH} * greatest(q50 - q25, {res}) AS lo FROM {name}_q),
{name} AS (SELECT {lead}max(total) AS group_size, {pick} FROM {name}_f {f'GROUP BY {keys}' if keys else ''})"""
    drop = f"greatest(length(bin(v)) - {Q.SKETCH_BITS}, 0)"
    limit = lambda c: (f"CASE WHEN own.group_size >= {Q.MIN_GROUP} THEN own.{c} "  # noqa: E731
                       f"WHEN by_lang.group_size >= {Q.MIN_GROUP} THEN by_lang.{c} ELSE every.{c} END")
    over = " OR ".join([f"coalesce({m} > {limit(m + '_hi')}, false)" for m in Q.RESOLUTION]
                       + [f"coalesce({m} < {limit(m + '_lo')}, false)" for m in Q.TWO_SIDED])
    return f"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
wins AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, {_slices(3)} FROM d WHERE len(w) >= 3),
grams AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a0, a1, a2) AS c FROM wins),
cover AS (SELECT DISTINCT doc_id, unnest([i, i + 1, i + 2]) AS pos FROM grams WHERE c > 1),
rep AS (SELECT doc_id, count(*) AS n FROM cover GROUP BY doc_id),
lines AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
c AS (SELECT d.doc_id, lang, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
        len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
        coalesce(rep.n, 0)::BIGINT AS n_repeat_words, len(string_split(t, chr(10)))::BIGINT AS n_lines,
        len(regexp_extract_all(t, '[A-Z]'))::BIGINT AS n_upper
      FROM d JOIN lines USING (doc_id) LEFT JOIN rep USING (doc_id)),
r AS (SELECT *, n_words < {Q.MIN_WORDS} OR 100 * n_repeat_words > {Q.REPEAT_PCT} * n_words AS base_failed,
        n_symbols * 1000000 // greatest(word_chars, 1) AS symbol_ppm, n_upper * 1000000 // greatest(word_chars, 1) AS upper_ppm,
        n_dup_lines * 1000000 // greatest(n_lines, 1) AS dup_line_ppm, word_chars * 1000 // greatest(n_words, 1) AS word_milli FROM c),
long AS ({' UNION ALL '.join(f"SELECT lang, source, '{m}' AS metric, {m} AS v FROM r WHERE NOT base_failed" for m in Q.RESOLUTION)}),
sketch AS (SELECT lang, source, metric, (v >> {drop}) << {drop} AS bucket, count(*) AS n FROM long GROUP BY ALL),
{fences('own', 'lang, source')}, {fences('by_lang', 'lang')}, {fences('every', '')}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT ({over}) AS kept, n_lines, n_upper
FROM r LEFT JOIN own ON r.lang IS NOT DISTINCT FROM own.lang AND r.source IS NOT DISTINCT FROM own.source
LEFT JOIN by_lang ON r.lang IS NOT DISTINCT FROM by_lang.lang LEFT JOIN every ON true
"""


def _secret_scan() -> str:
    def found(kinds, t) -> str:
        return " UNION ALL ".join(
            f"""SELECT doc_id, '{kind}' AS kind, {n} AS ord, {least} AS least, regexp_extract_all({t}, '{p}') AS f,
                regexp_extract_all({t}, '{p}', {group}) AS g, string_split_regex({t}, '{p}') AS gaps FROM d"""
            for n, kind, p, group, least in ((n, k, p.replace("'", "''"), g, least) for n, k, p, g, least in kinds))
    def placed(name: str, kinds, t: str) -> str:
        return f"""
{name}_f AS ({found(kinds, t)}),
{name} AS (SELECT doc_id, kind, ord, f[i] AS s, length(array_to_string(gaps[1:i], '')) + length(array_to_string(f[1:i - 1], '')) AS start
  FROM (SELECT *, unnest(range(1, len(f) + 1)) AS i FROM {name}_f) WHERE length(g[i]) >= least)"""
    base = [(n, *x) for n, x in enumerate(S.BASE)]
    more = [(len(base) + n, kind, f"{chars}{{{w},}}", 0, w) for n, (kind, chars, w, _) in enumerate(S.CLASSES)]
    size = "CASE kind " + " ".join(f"WHEN '{k}' THEN {w}" for k, _, w, _ in S.CLASSES) + " END"
    most = "CASE kind " + " ".join(f"WHEN '{k}' THEN {S.weight(w) - round(S.UNIT * bits * w)}" for k, _, w, bits in S.CLASSES) + " END"
    weight = "CASE c " + " ".join(f"WHEN {c} THEN {S.weight(c)}" for c in range(1, 1 + max(w for _, _, w, _ in S.CLASSES))) + " END"
    allow = S.ALLOW.replace("'", "''")
    cut = "coalesce(text, '')"
    for pattern, length in S.SAMPLES:
        cut = f"regexp_replace({cut}, '{pattern}', '{' ' * length}', 'g')"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {cut} AS cut FROM documents), {placed('base', base, 't')}, {placed('cand', more, 'cut')},
wins AS (SELECT doc_id, kind, ord, start, s, unnest(range(1, length(s) - {size} + 2)) AS w FROM cand WHERE NOT regexp_matches(s, '{allow}')),
chars AS (SELECT doc_id, kind, ord, start, w, unnest(string_split(substr(s, w, {size}), '')) AS ch FROM wins),
counts AS (SELECT doc_id, kind, ord, start, w, ch, count(*) AS c FROM chars GROUP BY ALL),
hits AS (SELECT doc_id, kind, ord, start, w FROM counts GROUP BY ALL HAVING sum({weight}) <= any_value({most})),
isl AS (SELECT *, CASE WHEN w - lag(w) OVER (PARTITION BY doc_id, ord, start ORDER BY w) <= {size} THEN 0 ELSE 1 END AS new FROM hits),
grp AS (SELECT *, sum(new) OVER (PARTITION BY doc_id, ord, start ORDER BY w) AS island FROM isl),
added AS (SELECT doc_id, kind, ord, start + min(w) - 1 AS start, start + max(w) - 1 + any_value({size}) AS stop FROM grp GROUP BY doc_id, kind, ord, start, island),
fixed AS (SELECT doc_id, kind, ord, start, start + length(s) AS stop, true AS is_base FROM base),
every AS (SELECT * FROM fixed UNION ALL SELECT doc_id, kind, ord, start, stop, false FROM added a
          WHERE NOT EXISTS (SELECT 1 FROM fixed f WHERE f.doc_id = a.doc_id AND f.start <= a.start AND a.stop <= f.stop)),
agg AS (SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS na, count(*) FILTER (WHERE kind = 'access') AS nc,
          count(*) FILTER (WHERE kind = 'hex') AS nh, count(*) FILTER (WHERE NOT is_base) AS ne,
          string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, ord) FILTER (WHERE is_base) AS b,
          string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, ord) AS spans FROM every GROUP BY doc_id)
SELECT d.doc_id, coalesce(na, 0)::BIGINT AS n_assign, coalesce(nc, 0)::BIGINT AS n_access, coalesce(nh, 0)::BIGINT AS n_hex,
       sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(ne, 0)::BIGINT AS n_entropy
FROM d LEFT JOIN agg USING (doc_id)
"""


def _license_scan() -> str:
    rows = []
    for name, text, label, is_base in [*((n, t, L.LABEL.get(n, n), False) for n, t in L.TEMPLATES.items()),
                                       *((p, p, lab, True) for p, lab in L.BASE.items())]:
        w = text.split()
        rows += [f"('{' '.join(w[i:i + L.K])}', '{name}', {i}, {len(w) - L.K + 1}, '{label}', {is_base})" for i in range(len(w) - L.K + 1)]
    return f"""
WITH t(gram, tmpl, tpos, n_windows, label, is_base) AS (VALUES {', '.join(rows)}),
d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '{L.WORDS}') AS w FROM documents),
g AS (SELECT doc_id, i - 1 AS pos, array_to_string(w[i:i + {L.K - 1}], ' ') AS gram
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - {L.K} + 2)) AS i FROM d)),
votes AS (SELECT doc_id, tmpl, label, is_base, n_windows, pos - tpos AS diag, list(DISTINCT tpos) AS tposs, min(pos) AS first, max(pos) AS last
          FROM g JOIN t USING (gram) GROUP BY ALL),
places AS (SELECT doc_id, label, diag AS place FROM votes WHERE is_base AND len(tposs) = n_windows),
steps AS (SELECT *, CASE WHEN diag - lag(diag) OVER w > {L.DRIFT} THEN 1 ELSE 0 END AS new FROM votes WHERE NOT is_base
          WINDOW w AS (PARTITION BY doc_id, tmpl ORDER BY diag)),
clustered AS (SELECT *, sum(new) OVER (PARTITION BY doc_id, tmpl ORDER BY diag) AS cluster FROM steps),
parts AS (SELECT doc_id, tmpl, label, n_windows, cluster, list_distinct(flatten(list(tposs))) AS tposs, min(first) AS first, max(last) + {L.K} AS last
          FROM clustered GROUP BY doc_id, tmpl, label, n_windows, cluster),
follow AS (SELECT *, CASE WHEN list_min(tposs) > lag(list_max(tposs)) OVER o AND first - lag(last) OVER o <= {L.INSERTED} THEN 0 ELSE 1 END AS apart
           FROM parts WINDOW o AS (PARTITION BY doc_id, tmpl ORDER BY first, last, cluster)),
chains AS (SELECT *, sum(apart) OVER (PARTITION BY doc_id, tmpl ORDER BY first, last, cluster) AS chain FROM follow),
spans AS (SELECT doc_id, label, len(list_distinct(flatten(list(tposs)))) / n_windows AS cover
          FROM chains GROUP BY doc_id, tmpl, label, n_windows, chain),
good AS (SELECT * FROM spans WHERE cover >= {L.MIN_COVER}),
b AS (SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
        string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM places GROUP BY doc_id),
s AS (SELECT doc_id, count(*) AS n_spans, max(cover) AS cover FROM good GROUP BY doc_id),
a AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
      FROM (SELECT doc_id, label FROM places UNION SELECT doc_id, label FROM good) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0 ELSE round(coalesce(cover, 0.0), 6) END::DOUBLE AS score, coalesce(n_spans, 0)::BIGINT AS n_spans
FROM d LEFT JOIN b USING (doc_id) LEFT JOIN s USING (doc_id) LEFT JOIN a USING (doc_id)
"""


SOURCE_DIVERGENCE = f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{D.TERM}') AS w FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM t GROUP BY ALL HAVING count(DISTINCT r) >= {D.MIN_DOCS}),
v AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
gn AS (SELECT g.lang, g.source, coalesce(sum(n), 0) AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
cell AS (SELECT gn.lang, gn.source, kept.term, coalesce(c.n, 0) AS n,
                1 + {D.SCALE}::HUGEINT * (coalesce(c.n, 0) + 2) // (gn.total + 2 * v.v) AS p,
                1 + {D.SCALE}::HUGEINT * (kept.n + 2) // (v.total + 2 * v.v) AS q
         FROM gn JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term)),
sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
         FROM cell a JOIN cell b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
         FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
         LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source),
term AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value FROM cell WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
           FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT * FROM ranked WHERE part = 'pair' OR rank <= {D.TOP}
"""


def _vector_codes() -> str:
    def nearest(r: int) -> str:
        # squared distance and index in one number: ties go to the lower index
        dot = "list_dot_product"
        return f"""
near{r} AS (SELECT v, p, min((({dot}(a, a) - 2 * {dot}(a, b) + {dot}(b, b))::HUGEINT) * {V.ENTRIES} + j) AS best
            FROM parts JOIN book{r} USING (p) GROUP BY v, p)"""

    def moved(r: int) -> str:
        return f"""
cell{r} AS (SELECT p, best % {V.ENTRIES} AS j, unnest(a) AS c, generate_subscripts(a, 1) AS pos FROM parts JOIN near{r} USING (v, p)),
mean{r} AS (SELECT p, j, pos, floor(sum(c) / count(*)) AS c FROM cell{r} GROUP BY ALL),
new{r} AS (SELECT p, j, list(c ORDER BY pos) AS b FROM mean{r} GROUP BY ALL),
book{r + 1} AS (SELECT p, j, coalesce(n.b, o.b) AS b FROM book{r} o LEFT JOIN new{r} n USING (p, j))"""
    steps = ",".join([nearest(r) + "," + moved(r) for r in range(V.ROUNDS)] + [nearest(V.ROUNDS)])
    return f"""
WITH kept AS (SELECT row_number() OVER (ORDER BY vec_id) AS v, vec_id, label, list_transform(embedding, lambda x: floor({V.SCALE} * x::DOUBLE)) AS x
              FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
w AS (SELECT max(len(x)) // {V.PARTS} AS w FROM kept),
parts AS (SELECT v, p, x[p * w + 1:(p + 1) * w] AS a FROM kept, w, (SELECT unnest(range({V.PARTS})) AS p)),
book0 AS (SELECT p, v - 1 AS j, a AS b FROM parts WHERE v <= {V.ENTRIES}),{steps},
books AS (SELECT sha256(string_agg(c::BIGINT::VARCHAR, ',' ORDER BY p, j, pos)) AS h
          FROM (SELECT p, j, unnest(b) AS c, generate_subscripts(b, 1) AS pos FROM book{V.ROUNDS})),
coded AS (SELECT v, string_agg(format('{{:02x}}', (best % {V.ENTRIES})::INT), '' ORDER BY p) AS code,
                 sum(best // {V.ENTRIES})::BIGINT AS error FROM near{V.ROUNDS} GROUP BY v)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256
FROM kept JOIN coded USING (v), books
"""


ORACLES = {
    "op1_secret_scan": _secret_scan(),
    "op4_substring_dedup": SUBSTRING_DEDUP,
    "op5_line_dedup": LINE_DEDUP,
    "op6_license_scan": _license_scan(),
    "op10_quality_rules": _quality_rules(),
    "op11_vector_codes": _vector_codes(),
    "op13_source_divergence_audit": SOURCE_DIVERGENCE,
}
