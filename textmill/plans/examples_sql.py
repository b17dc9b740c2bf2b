"""DuckDB oracle CTEs for example generation over the encoded documents."""

from __future__ import annotations

from textmill.functions.rng import draw_sql
from textmill.plans import oracle_sql as O

SEED = 0


def _d(salt: str, *keys: str) -> str:
    return draw_sql(SEED, salt, *keys)


EX_CTES = [*[O.DOC_WORDS, O.DOC_SENTS, O.sent_words(), O.demo_vocab(), O.encode_words(), O.encode_sents()], """
sizes AS (SELECT paragraph_id, count(*) AS n FROM enc_sents GROUP BY paragraph_id)""", """
ranked AS (SELECT paragraph_id, n, row_number() OVER (ORDER BY paragraph_id) - 1 AS rank FROM sizes)""", """
elig AS (SELECT paragraph_id, n, rank, row_number() OVER (ORDER BY paragraph_id) - 1 AS erank FROM ranked WHERE n >= 2)""", """
consts AS (SELECT (SELECT count(*) FROM ranked) AS P, (SELECT count(*) FROM elig) AS E,
                  (SELECT count(*) FROM vocab) AS T)""", """
sent AS (SELECT r.rank, e.idx, e.ids, r.paragraph_id FROM enc_sents e JOIN ranked r USING (paragraph_id))""", """
sentg AS (SELECT rank, idx, ids, idx - (row_number() OVER (PARTITION BY rank, ids ORDER BY idx) - 1) AS g FROM sent)""",
f"""
ex AS (SELECT range AS example_id, {_d('nsp', 'range')} % 2 = 1 AS nsp, {_d('p0', 'range')} AS u0,
              {_d('p1', 'range')} AS u1, {_d('s0', 'range')} AS us0, {_d('s1', 'range')} AS us1
       FROM range(0, (SELECT count(*) FROM doc_sents)))""", """
pos1 AS (SELECT ex.example_id, ex.nsp, el.rank AS r0, ex.us0 % (el.n - 1) AS s0
         FROM ex, consts JOIN elig el ON el.erank = ex.u0 % consts.E WHERE ex.nsp)""", """
neg1 AS (SELECT ex.example_id, ex.nsp, a.rank AS r0, ex.us0 % a.n AS s0,
                (a.rank + 1 + ex.u1 % (consts.P - 1)) % consts.P AS r1, ex.us1
         FROM ex, consts JOIN ranked a ON a.rank = ex.u0 % consts.P WHERE NOT ex.nsp)""", """
neg2 AS (SELECT neg1.*, b.n AS n1, nx.ids AS nxt FROM neg1 JOIN ranked b ON b.rank = neg1.r1
         LEFT JOIN sent nx ON nx.rank = neg1.r0 AND nx.idx = neg1.s0 + 1)""", """
neg3 AS (SELECT neg2.*, (SELECT count(*) FROM sent c WHERE c.rank = neg2.r1 AND c.ids = neg2.nxt) AS m FROM neg2)""", """
neg4 AS (SELECT *, us1 % (n1 - m) AS r FROM neg3 WHERE n1 - m > 0)""", """
neg5 AS (SELECT neg4.*, r + (SELECT count(*) FROM sentg c WHERE c.rank = neg4.r1 AND c.ids = neg4.nxt AND c.g <= neg4.r) AS s1
         FROM neg4)""", """
chosen AS (SELECT example_id, nsp, r0, s0, r0 AS rb, s0 + 1 AS sb FROM pos1
           UNION ALL SELECT example_id, nsp, r0, s0, r1 AS rb, s1 AS sb FROM neg5)""", """
pairs AS (SELECT c.example_id, c.nsp, c.r0, c.s0, c.rb, c.sb, a.ids AS a, b.ids AS b
          FROM chosen c JOIN sent a ON a.rank = c.r0 AND a.idx = c.s0 JOIN sent b ON b.rank = c.rb AND b.idx = c.sb)""", """
m1 AS (SELECT example_id, nsp, list_concat([2], a, [3], b, [3]) AS src FROM pairs)""", """
m2 AS (SELECT *, len(src) AS L, len(list_filter(src, lambda x: x NOT IN (2, 3))) AS nc,
              CAST(floor(len(src) * 0.15::DOUBLE) AS INTEGER) AS k FROM m1)""", """
m3 AS (SELECT *, (k = 0 OR k > nc) AS fb FROM m2 WHERE nc > 0)""", f"""
m4 AS (SELECT example_id, nsp, src, L,
              CASE WHEN fb THEN 1 ELSE k END AS kk,
              CASE WHEN fb THEN 1 ELSE CAST(floor(k * 0.8::DOUBLE) AS INTEGER) END AS nm,
              CASE WHEN fb THEN 0 ELSE CAST(floor(k * 0.1::DOUBLE) AS INTEGER) END AS ns,
              5 + {_d('rtok', 'example_id')} % ((SELECT T FROM consts) - 5) AS base,
              (SELECT T FROM consts) - 5 AS span,
              list_transform(list_sort(list_transform(list_sort(list_transform(range(0, L),
                lambda p: {{'d': CASE WHEN src[p + 1] IN (2, 3) THEN 4611686018427387904 + p
                                     ELSE {_d('mlm', 'example_id', 'p')} END, 'p': CAST(p AS INTEGER)}})),
                lambda s, j: {{'p': s.p, 'j': CAST(j - 1 AS INTEGER)}})), lambda s: s.j) AS rk
       FROM m3)""", """
examples AS (SELECT example_id, nsp, src, kk, nm, ns,
  list_transform(src, lambda x, i: CASE
      WHEN rk[i] < nm THEN 4
      WHEN rk[i] < nm + ns THEN x
      WHEN rk[i] < kk THEN CASE
          WHEN 5 + (base - 5 + (rk[i] - nm - ns) * 1000003) % span = x
          THEN 5 + ((base - 5 + (rk[i] - nm - ns) * 1000003) % span + 1) % span
          ELSE 5 + (base - 5 + (rk[i] - nm - ns) * 1000003) % span END
      ELSE x END) AS mlm,
  list_transform(rk, lambda r: r < kk) AS mask
  FROM m4)"""]


def with_examples(*extra: str) -> str:
    return O.with_(*EX_CTES, *extra)
