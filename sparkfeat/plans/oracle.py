"""DuckDB SQL for every oracle-checked query in ``queries`` (same column names).

Literal doubles are written with CAST so DuckDB does not read them as
DECIMAL; computed doubles are rounded with the same 9-significant-digit
rule as the Spark side (``sig_sql``).
"""
from __future__ import annotations

from ..functions.exprs import sig_sql as S

LCOLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
WINDOWS = [10, 20, 50, 100]


def D(x) -> str:
    """A double literal."""
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def _union(parts):
    return "\nUNION ALL\n".join(parts)


# ---------------------------------------------------------------- shared CTEs
EMB_SPLIT = """
emb_h AS (SELECT vec_id, label,
                 CAST(('0x' || substr(md5(CAST(vec_id AS VARCHAR) || '|42'), 1, 13)) AS BIGINT) AS h
          FROM embeddings),
emb_c AS (SELECT label, count(*) AS nc FROM embeddings GROUP BY label),
emb_t AS (SELECT sum(nc) AS n, CAST(ceil(CAST(0.2 AS DOUBLE) * sum(nc)) AS BIGINT) AS nt FROM emb_c),
emb_a AS (SELECT c.label, t.nt * c.nc / t.n AS ex, floor(t.nt * c.nc / t.n) AS base, t.nt
          FROM emb_c c, emb_t t),
emb_b AS (SELECT label, base + CASE WHEN row_number() OVER (ORDER BY ex - base DESC, label) <= nt - sum(base) OVER ()
                              THEN 1 ELSE 0 END AS take FROM emb_a),
emb_s AS (SELECT h.vec_id, h.label,
                 CASE WHEN row_number() OVER (PARTITION BY h.label ORDER BY h.h, h.vec_id) - 1 < b.take
                      THEN 'test' ELSE 'train' END AS split
          FROM emb_h h JOIN emb_b b USING (label)),
emb_long AS (SELECT vec_id, label, CAST(unnest(range(len(embedding))) AS INTEGER) AS d,
                    CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)"""

GNB = EMB_SPLIT + """,
gtr AS (SELECT l.* FROM emb_long l JOIN emb_s s USING (vec_id) WHERE s.split = 'train'),
gte AS (SELECT l.* FROM emb_long l JOIN emb_s s USING (vec_id) WHERE s.split = 'test'),
geps AS (SELECT max(v) * CAST('1e-09' AS DOUBLE) AS eps FROM (SELECT var_pop(x) AS v FROM gtr GROUP BY d)),
gn AS (SELECT count(*) AS n FROM emb_s WHERE split = 'train'),
gprior AS (SELECT label AS cls, count(*) / (SELECT n FROM gn) AS prior FROM emb_s WHERE split = 'train' GROUP BY label),
gstat AS (SELECT label AS cls, d, avg(x) AS mu, var_pop(x) + (SELECT eps FROM geps) AS var FROM gtr GROUP BY label, d),
gjll AS (SELECT t.vec_id, s.cls,
                ln(p.prior) - 0.5 * sum(ln(2 * pi() * s.var) + (t.x - s.mu) * (t.x - s.mu) / s.var) AS jll
         FROM gte t JOIN gstat s ON t.d = s.d JOIN gprior p ON p.cls = s.cls
         GROUP BY t.vec_id, s.cls, p.prior),
gbest AS (SELECT vec_id, cls AS pred, jll FROM
          (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY jll DESC, cls) AS r FROM gjll) WHERE r = 1),
glse AS (SELECT j.vec_id, max(b.jll) + ln(sum(exp(j.jll - b.jll))) AS lse
         FROM gjll j JOIN gbest b USING (vec_id) GROUP BY j.vec_id),
gpred AS (SELECT e.vec_id, e.label, b.pred, exp(j.jll - l.lse) AS p_true
          FROM (SELECT vec_id, label FROM emb_s WHERE split = 'test') e
          JOIN gbest b USING (vec_id) JOIN glse l USING (vec_id)
          LEFT JOIN gjll j ON j.vec_id = e.vec_id AND j.cls = e.label)"""

KNN = GNB + """,
kd AS (SELECT q.vec_id AS qid, r.vec_id AS cid, r.label AS clabel, sqrt(sum((q.x - r.x) * (q.x - r.x))) AS dist
       FROM gte q JOIN gtr r ON q.d = r.d GROUP BY q.vec_id, r.vec_id, r.label),
kr AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, cid) AS rk FROM kd),
kv AS (SELECT qid, clabel, count(*) AS votes FROM kr WHERE rk <= 5 GROUP BY qid, clabel),
kp AS (SELECT qid AS vec_id, clabel AS pred FROM
       (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY votes DESC, clabel) AS r FROM kv) WHERE r = 1),
knn AS (SELECT e.vec_id, e.label, kp.pred FROM (SELECT vec_id, label FROM emb_s WHERE split = 'test') e
        JOIN kp USING (vec_id)),
both_models AS (SELECT vec_id, label, pred, 'gaussian_nb' AS model FROM gpred
                UNION ALL SELECT vec_id, label, pred, 'knn_5' AS model FROM knn)"""


def per_class(src: str, by: str = "") -> str:
    """CTE text: pc_pairs, pc (class, tp, support, predicted, precision, recall, f1)."""
    b = f"{by}, " if by else ""
    on = f" AND p.{by} = c.{by}" if by else ""
    return f"""
pc_pairs AS (SELECT {b}label AS y, pred AS yhat, count(*) AS n FROM {src} GROUP BY ALL),
pc_cls AS (SELECT {b}y AS c FROM pc_pairs UNION SELECT {b}yhat FROM pc_pairs),
pc0 AS (SELECT {"c." + by + ", " if by else ""}c.c AS class,
               CAST(coalesce(sum(CASE WHEN p.y = c.c AND p.yhat = c.c THEN p.n END), 0) AS BIGINT) AS tp,
               CAST(coalesce(sum(CASE WHEN p.y = c.c THEN p.n END), 0) AS BIGINT) AS support,
               CAST(coalesce(sum(CASE WHEN p.yhat = c.c THEN p.n END), 0) AS BIGINT) AS predicted
        FROM pc_cls c JOIN pc_pairs p ON TRUE{on} GROUP BY ALL),
pc1 AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE CAST(0 AS DOUBLE) END AS precision,
                  CASE WHEN support > 0 THEN tp / support ELSE CAST(0 AS DOUBLE) END AS recall FROM pc0),
pc AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
                      ELSE CAST(0 AS DOUBLE) END AS f1 FROM pc1)"""


def weighted(by: str = "") -> str:
    b = f"{by}, " if by else ""
    return f"""SELECT {b}sum(tp) / sum(support) AS accuracy,
       sum(precision * support) / sum(support) AS precision,
       sum(recall * support) / sum(support) AS recall,
       sum(f1 * support) / sum(support) AS f1
FROM pc GROUP BY ALL"""


def _hist(table: str, cols, bins: int) -> str:
    parts = []
    for c in cols:
        parts.append(f"""SELECT '{c}' AS "column", CAST(t.i AS INTEGER) AS bin,
       {S(f"s.lo + t.i * ((s.hi - s.lo) / {bins})")} AS lower,
       {S(f"s.lo + (t.i + 1) * ((s.hi - s.lo) / {bins})")} AS upper,
       CAST(coalesce(b.c, 0) AS BIGINT) AS count
FROM (SELECT min({c}) AS lo, max({c}) AS hi FROM {table}) s
CROSS JOIN range(0, {bins}) t(i)
LEFT JOIN (SELECT least(floor(({c} - s2.lo) * {bins} / (s2.hi - s2.lo)), {bins - 1}) AS bin, count(*) AS c
           FROM {table}, (SELECT min({c}) AS lo, max({c}) AS hi FROM {table}) s2 GROUP BY 1) b ON b.bin = t.i""")
    return _union(parts)


def _entropy_cte(table: str, c: str, bins: int = 20) -> str:
    return f"""(SELECT ln(sum(c1)) - sum(c1 * ln(c1)) / sum(c1) FROM
  (SELECT coalesce(b.c, 0) + 1 AS c1 FROM range(0, {bins}) t(i) LEFT JOIN
    (SELECT least(floor(({c} - s.lo) * {bins} / (s.hi - s.lo)), {bins - 1}) AS bin, count(*) AS c
     FROM {table}, (SELECT min({c}) AS lo, max({c}) AS hi FROM {table}) s GROUP BY 1) b ON b.bin = t.i))"""


def _quantile_near(table: str, c: str, q: float) -> str:
    return f"""SELECT '{c}' AS "column", {D(q)} AS q, {S('x')} AS value FROM
  (SELECT {c} AS x, row_number() OVER (ORDER BY {c}) - 1 AS i, count(*) OVER () AS n FROM {table})
  WHERE i = round_even(CAST(n - 1 AS DOUBLE) * {D(q)}, 0)"""


def _scale_sql(kind: str) -> str:
    sel = []
    for c in LCOLS:
        if kind in ("minmax", "minmax_safe"):
            e = f"({c} - (SELECT min({c}) FROM lineitem)) / ((SELECT max({c}) FROM lineitem) - (SELECT min({c}) FROM lineitem))"
        elif kind == "standard_samp":
            e = f"({c} - (SELECT avg({c}) FROM lineitem)) / (SELECT stddev_samp({c}) FROM lineitem)"
        elif kind == "standard_pop":
            e = f"({c} - (SELECT avg({c}) FROM lineitem)) / (SELECT stddev_pop({c}) FROM lineitem)"
        elif kind == "robust":
            e = (f"({c} - (SELECT quantile_cont({c}, 0.5) FROM lineitem)) / "
                 f"((SELECT quantile_cont({c}, 0.75) FROM lineitem) - (SELECT quantile_cont({c}, 0.25) FROM lineitem))")
        elif kind == "maxabs":
            e = f"{c} / (SELECT max(abs({c})) FROM lineitem)"
        sel.append(f"{S(e)} AS {c}")
    return f"SELECT l_orderkey, l_linenumber, {', '.join(sel)} FROM lineitem"


def _rolling_sql(windows, kind: str, partition: str = "", mp=None, digits: int = 9) -> str:
    part = f"PARTITION BY {partition} " if partition else ""
    sel, wins = [], []
    for w in windows:
        wins.append(f"w{w} AS ({part}ORDER BY ts, event_id ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)")
        need = w if mp is None else mp
        if "mean" in kind:
            sel.append(f"{S(f'CASE WHEN count(value) OVER w{w} >= {need} THEN avg(value) OVER w{w} END', digits)} AS value_MA_{w}")
        if "var" in kind:
            sel.append(f"{S(f'CASE WHEN count(value) OVER w{w} >= {need} THEN var_samp(value) OVER w{w} END', 6)} AS value_VAR_{w}")
    keep = f"event_id, {partition}, " if partition else "event_id, "
    return f"SELECT {keep}{', '.join(sel)} FROM events WINDOW {', '.join(wins)}"


def _ema_sql(spans) -> str:
    qs = {w: 1.0 - 2.0 / (w + 1.0) for w in spans}
    init = ", ".join(f"value, CAST(1 AS DOUBLE)" for w in spans)
    cols = ", ".join(f"n{w}, d{w}" for w in spans)
    step = ", ".join(f"r.n{w} * {D(qs[w])} + o.value, r.d{w} * {D(qs[w])} + 1" for w in spans)
    out = ", ".join(f"{S(f'n{w} / d{w}')} AS value_EMA_{w}" for w in spans)
    return f"""WITH RECURSIVE o AS (SELECT event_id, value, row_number() OVER (ORDER BY ts, event_id) - 1 AS rn FROM events),
r(rn, event_id, {cols}) AS (
  SELECT rn, event_id, {init} FROM o WHERE rn = 0
  UNION ALL
  SELECT o.rn, o.event_id, {step} FROM r JOIN o ON o.rn = r.rn + 1)
SELECT event_id, {out} FROM r"""


def _stat_features() -> str:
    parts = []
    for c in LCOLS:
        mu = f"(SELECT avg({c}) FROM lineitem)"
        parts.append(f"""SELECT '{c}' AS "column", {S(f'avg({c})')} AS mean, {S(f'quantile_cont({c}, 0.5)')} AS median,
  {S(f'var_pop({c})')} AS variance, {S(f'stddev_pop({c})')} AS std, {S(f'sqrt(avg({c} * {c}))')} AS rms,
  {S(f'sum({c} * {c})')} AS energy, {S(_entropy_cte('lineitem', c))} AS entropy,
  {S(f'avg(power({c} - {mu}, 4)) / (avg(power({c} - {mu}, 2)) * avg(power({c} - {mu}, 2))) - 3')} AS kurtosis,
  {S(f'avg(power({c} - {mu}, 3)) / power(avg(power({c} - {mu}, 2)), 1.5)')} AS skewness
FROM lineitem""")
    return _union(parts)


def _spectrum_framed() -> str:
    ang = "2 * pi() * ((k * j) % n_f) / n_f"
    return f"""WITH o AS (SELECT user_id, value AS x,
              row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS rn,
              count(*) OVER (PARTITION BY user_id) AS nu FROM events),
f AS (SELECT user_id, rn // 64 AS frame, rn % 64 AS j, least(64, nu - (rn // 64) * 64) AS n_f, x FROM o),
kk AS (SELECT f.*, t.k FROM f JOIN range(0, 64) t(k) ON t.k < f.n_f),
s AS (SELECT user_id, frame, k, any_value(n_f) AS n_f, sum(x * cos({ang})) AS re, -sum(x * sin({ang})) AS im
      FROM kk GROUP BY user_id, frame, k),
m AS (SELECT *, sqrt(re * re + im * im) AS mag FROM s),
tot AS (SELECT user_id, frame, sum(mag) AS tot FROM m GROUP BY user_id, frame),
dom AS (SELECT user_id, frame, k AS dominant_k FROM
        (SELECT *, row_number() OVER (PARTITION BY user_id, frame ORDER BY mag DESC, k) AS r FROM m
         WHERE k >= 1 AND k <= n_f // 2) WHERE r = 1)
SELECT m.user_id, m.frame, CAST(any_value(m.n_f) AS BIGINT) AS n, CAST(any_value(d.dominant_k) AS INTEGER) AS dominant_k,
       {S('sum(m.mag * m.mag)', 6)} AS spectral_energy,
       {S('-sum(CASE WHEN m.mag > 0 THEN (m.mag / t.tot) * ln(m.mag / t.tot) ELSE 0 END)', 6)} AS spectral_entropy
FROM m JOIN tot t USING (user_id, frame) LEFT JOIN dom d USING (user_id, frame)
GROUP BY m.user_id, m.frame"""


SPARK_TYPES = """CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
  WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'FLOAT' THEN 'float'
  WHEN 'BOOLEAN' THEN 'boolean' ELSE lower(data_type) END"""


def _iqr(table: str, cols) -> str:
    parts = []
    for c in cols:
        q1, q3 = f"quantile_cont({c}, 0.25)", f"quantile_cont({c}, 0.75)"
        parts.append(f"""SELECT '{c}' AS "column", {S('q1')} AS q1, {S('q3')} AS q3, {S('q3 - q1')} AS iqr,
  {S('q1 - 1.5 * (q3 - q1)')} AS lower, {S('q3 + 1.5 * (q3 - q1)')} AS upper,
  (SELECT count(*) FROM {table} WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM (SELECT {q1} AS q1, {q3} AS q3 FROM {table})""")
    return _union(parts)


def _box() -> str:
    parts = []
    for c in LCOLS:
        parts.append(f"""SELECT '{c}' AS "column", {S('mn')} AS min, {S('q1')} AS q1, {S('med')} AS median, {S('q3')} AS q3,
  {S('mx')} AS max,
  {S(f'(SELECT min({c}) FROM lineitem WHERE {c} >= q1 - 1.5 * (q3 - q1) AND {c} <= q3 + 1.5 * (q3 - q1))')} AS whisker_low,
  {S(f'(SELECT max({c}) FROM lineitem WHERE {c} >= q1 - 1.5 * (q3 - q1) AND {c} <= q3 + 1.5 * (q3 - q1))')} AS whisker_high,
  (SELECT count(*) FROM lineitem WHERE NOT ({c} >= q1 - 1.5 * (q3 - q1) AND {c} <= q3 + 1.5 * (q3 - q1))) AS n_fliers
FROM (SELECT min({c}) AS mn, max({c}) AS mx, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS med,
             quantile_cont({c}, 0.75) AS q3 FROM lineitem)""")
    return _union(parts)


def _corr() -> str:
    return _union([f"""SELECT '{a}' AS col_a, '{b}' AS col_b, {S(f'corr({a}, {b})')} AS corr FROM lineitem"""
                   for a in LCOLS for b in LCOLS])


def _affine_params() -> str:
    parts = []
    for c in LCOLS:
        parts.append(f"""SELECT '{c}' AS col, least(min({c}), 0) AS mn, greatest(max({c}), 0) AS mx FROM lineitem""")
    return f"""ap0 AS ({_union(parts)}),
ap AS (SELECT col, (mx - mn) / 255 AS scale, round_even(-128 - mn / ((mx - mn) / 255), 0) AS zp FROM ap0)"""


def _affine_codes() -> str:
    sel = ", ".join(
        f"CAST(greatest(-128, least(127, round_even({c} / (SELECT scale FROM ap WHERE col = '{c}') + "
        f"(SELECT zp FROM ap WHERE col = '{c}'), 0))) AS TINYINT) AS {c}" for c in LCOLS)
    return f"WITH {_affine_params()} SELECT l_orderkey, l_linenumber, {sel} FROM lineitem"


def _dequant_error() -> str:
    parts = []
    for c in LCOLS:
        code = (f"greatest(-128, least(127, round_even({c} / ap.scale + ap.zp, 0)))")
        parts.append(f"""SELECT '{c}' AS "column", {S('any_value(ap.scale)')} AS scale, {S('any_value(ap.zp)')} AS zero_point,
  {S(f'max(abs((CAST({code} AS DOUBLE) - ap.zp) * ap.scale - {c}))')} AS max_abs_error,
  max(abs((CAST({code} AS DOUBLE) - ap.zp) * ap.scale - {c})) <= any_value(ap.scale) / 2 * (1 + CAST('1e-09' AS DOUBLE)) AS within_bound
FROM lineitem, ap WHERE ap.col = '{c}'""")
    return f"WITH {_affine_params()} {_union(parts)}"


KEEP = 1.0 - 0.7


def _prune_cte() -> str:
    return f"""pl AS (SELECT vec_id, label, d AS dim, x AS w, vec_id * 64 + d AS wid FROM emb_long),
pr AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY abs(w), wid) - 1 AS rn,
              count(*) OVER (PARTITION BY label) AS n FROM pl),
pruned AS (SELECT vec_id, label, dim, CASE WHEN rn < n - round_even(n * {D(KEEP)}, 0) THEN CAST(0 AS DOUBLE) ELSE w END
                  AS weight FROM pr)"""


def _grid_knn() -> str:
    return EMB_SPLIT + """,
tr AS (SELECT h.vec_id, h.label, h.h FROM emb_h h JOIN emb_s s USING (vec_id) WHERE s.split = 'train'),
fo AS (SELECT vec_id, label, CAST((row_number() OVER (PARTITION BY label ORDER BY h, vec_id) - 1) % 3 AS INTEGER) AS fold FROM tr),
lf AS (SELECT l.*, f.fold FROM emb_long l JOIN fo f USING (vec_id)),
kd AS (SELECT q.vec_id AS qid, q.fold AS f, r.vec_id AS cid, r.label AS clabel,
              sqrt(sum((q.x - r.x) * (q.x - r.x))) AS dist
       FROM lf q JOIN lf r ON q.d = r.d AND q.fold <> r.fold GROUP BY q.vec_id, q.fold, r.vec_id, r.label),
kr AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, cid) AS rk FROM kd),
ks AS (SELECT unnest([3, 5, 7, 9]) AS k),
kv AS (SELECT ks.k, kr.qid, kr.f, kr.clabel, count(*) AS votes FROM kr JOIN ks ON kr.rk <= ks.k GROUP BY ALL),
kp AS (SELECT k, qid, f, clabel AS pred FROM
       (SELECT *, row_number() OVER (PARTITION BY k, qid ORDER BY votes DESC, clabel) AS r FROM kv) WHERE r = 1),
acc AS (SELECT kp.k, kp.f, avg(CAST(kp.pred = fo.label AS DOUBLE)) AS acc FROM kp JOIN fo ON fo.vec_id = kp.qid GROUP BY ALL),
sm AS (SELECT k, avg(acc) AS mean_accuracy, stddev_pop(acc) AS std_accuracy FROM acc GROUP BY k)
SELECT CAST(k AS INTEGER) AS k, """ + S("mean_accuracy") + " AS mean_accuracy, " + S("std_accuracy") + \
        """ AS std_accuracy, CAST(rank() OVER (ORDER BY mean_accuracy DESC, k) AS INTEGER) AS rank FROM sm"""


def _grid_knn_test() -> str:
    """The grid's best k on the whole training part, scored on the test part."""
    grid = _grid_knn()
    return grid[:grid.rindex("SELECT CAST(k AS INTEGER)")].rstrip() + """,
bk AS (SELECT k, mean_accuracy FROM sm ORDER BY mean_accuracy DESC, k LIMIT 1),
te AS (SELECT l.* FROM emb_long l JOIN emb_s s USING (vec_id) WHERE s.split = 'test'),
td AS (SELECT q.vec_id AS qid, r.vec_id AS cid, r.label AS clabel, sqrt(sum((q.x - r.x) * (q.x - r.x))) AS dist
       FROM te q JOIN lf r ON q.d = r.d GROUP BY q.vec_id, r.vec_id, r.label),
tr2 AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, cid) AS rk FROM td),
tv AS (SELECT qid, clabel, count(*) AS votes FROM tr2 JOIN bk ON rk <= k GROUP BY ALL),
tp AS (SELECT qid, clabel AS pred FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY votes DESC, clabel) AS r FROM tv) WHERE r = 1)
SELECT CAST(any_value(k) AS INTEGER) AS best_k, """ + S("any_value(mean_accuracy)") + " AS cv_accuracy, " + \
        S("avg(CAST(pred = s.label AS DOUBLE))") + """ AS test_accuracy, count(*) AS n_test
FROM tp JOIN emb_s s ON s.vec_id = tp.qid CROSS JOIN bk"""


def _sparsity_sweep() -> str:
    return f"WITH {EMB_SPLIT}, {_prune_cte()}," + f"""
nt AS (SELECT count(*) AS n FROM emb_s WHERE split = 'train'),
te AS (SELECT CAST(ceil(n / 8) * 10 AS BIGINT) AS T FROM nt),
lv AS (SELECT CAST(s.step AS INTEGER) AS step,
              CAST(0.7 AS DOUBLE) + (CAST(0 AS DOUBLE) - CAST(0.7 AS DOUBLE)) * power(1 - s.step / te.T, 3) AS target
       FROM te, range(0, (SELECT T FROM te) + 1, 100) s(step))
SELECT pr.label, any_value(pr.n) AS n, lv.step, {S('lv.target')} AS target_sparsity,
       count(*) FILTER (WHERE pr.rn < pr.n - round_even(pr.n * (1 - lv.target), 0) OR pr.w = 0) AS n_zero,
       {S('100.0 * count(*) FILTER (WHERE pr.rn < pr.n - round_even(pr.n * (1 - lv.target), 0) OR pr.w = 0) / any_value(pr.n)')} AS achieved_pct
FROM pr, lv GROUP BY pr.label, lv.step, lv.target"""


def oracle_sql() -> dict[str, str]:
    ev_cols = "event_id, ts, user_id, event_type, value, props"
    q = {}
    q["csv_roundtrip"] = "SELECT * FROM nation"
    q["csv_roundtrip_orders"] = "SELECT * FROM orders"
    q["split_roundtrip"] = f"WITH {EMB_SPLIT} SELECT s.vec_id, s.label, s.split, CAST(len(e.embedding) AS INTEGER) AS dims " \
                           "FROM emb_s s JOIN embeddings e USING (vec_id) WHERE s.split = 'test'"
    q["project_columns"] = ("SELECT l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
                            "l_returnflag FROM lineitem")
    q["first_rows"] = f"SELECT {ev_cols} FROM events ORDER BY ts, event_id LIMIT 10"
    q["cast_types"] = ("SELECT event_id, CAST(value AS FLOAT) AS value_f32, "
                       "CAST(greatest(-128, least(127, round_even(value, 0))) AS TINYINT) AS value_i8, "
                       "CAST(event_type = 'click' AS INTEGER) AS is_click FROM events")
    q["label_names"] = ("SELECT event_id, CAST(dense_rank() OVER (ORDER BY event_type) - 1 AS INTEGER) AS event_type_id, "
                        "event_type AS event_type_name FROM events")
    q["profile_counts"] = ("SELECT count(*) AS n_rows, "
                           "(SELECT CAST(count(*) AS INTEGER) FROM information_schema.columns WHERE table_name = 'lineitem') AS n_cols, "
                           "(SELECT CAST(count(*) - 1 AS INTEGER) FROM information_schema.columns WHERE table_name = 'lineitem') AS n_features "
                           "FROM lineitem")
    q["profile_schema"] = (f"SELECT CAST(ordinal_position AS INTEGER) AS position, column_name, {SPARK_TYPES} AS data_type "
                           "FROM information_schema.columns WHERE table_name = 'lineitem'")
    q["describe_numeric"] = _union([
        f"""SELECT '{c}' AS "column", count({c}) AS count, count(*) - count({c}) AS nulls, {S(f'avg({c})')} AS mean,
  {S(f'stddev_samp({c})')} AS std, {S(f'min({c})')} AS min, {S(f'quantile_cont({c}, 0.25)')} AS q25,
  {S(f'quantile_cont({c}, 0.5)')} AS median, {S(f'quantile_cont({c}, 0.75)')} AS q75, {S(f'max({c})')} AS max
FROM lineitem""" for c in LCOLS])
    onull = ("(SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_totalprice END "
             "AS o_totalprice, o_orderdate, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS "
             "o_orderpriority FROM orders)")
    ocols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    q["null_counts"] = _union(
        [f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS null_count FROM {onull}" for c in ocols] +
        [f"SELECT '__total__' AS \"column\", {' + '.join(f'(count(*) - count({c}))' for c in ocols)} AS null_count FROM {onull}"])
    docs = "(SELECT text, lang, source, n_chars FROM documents)"
    q["duplicate_count"] = f"SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {docs})) AS duplicates FROM {docs}"
    q["dedup_report"] = (f"SELECT count(*) AS before, (SELECT count(*) FROM (SELECT DISTINCT * FROM {docs})) AS after, "
                         f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {docs})) AS removed FROM {docs}")
    q["dedup_rows"] = f"SELECT DISTINCT * FROM {docs}"
    q["distinct_classes"] = "SELECT DISTINCT l_returnflag FROM lineitem ORDER BY 1"
    q["class_balance"] = "SELECT l_returnflag, count(*) AS count FROM lineitem GROUP BY 1 ORDER BY 1"
    q["value_counts"] = "SELECT event_type, count(*) AS count FROM events GROUP BY 1 ORDER BY 2 DESC, 1"
    q["quantile_nearest"] = _union([_quantile_near("lineitem", c, qq) for c in LCOLS for qq in (0.25, 0.5, 0.75)])
    q["quantile_linear"] = _union([f"""SELECT 'value' AS "column", {D(qq)} AS q, {S(f'quantile_cont(value, {D(qq)})')} AS value FROM events"""
                                   for qq in (0.1, 0.25, 0.5, 0.75, 0.9)])
    q["box_numbers"] = _box()
    q["iqr_counts"] = _iqr("events", ["value", "user_id"])
    q["iqr_cells"] = f"SELECT CAST(sum(n_outliers) AS BIGINT) AS outlier_cells FROM ({_iqr('events', ['value', 'user_id'])})"
    q["iqr_rows"] = ("SELECT event_id, value, 1 AS n_outlier_cols FROM events, "
                     "(SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events) s "
                     "WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)")
    q["histogram_20"] = _hist("events", ["value"], 20)
    q["histogram_50"] = _hist("lineitem", LCOLS, 50)
    q["correlation_matrix"] = _corr()
    q["size_estimate"] = (f"SELECT count(*) AS n_rows, 5 AS n_features, CAST(count(*) * 5 * 4 AS BIGINT) AS bytes, "
                          f"{S('count(*) * 5 * 4 / 1024.0')} AS kb FROM events")
    q["column_bytes"] = _union([
        "SELECT 'event_id' AS \"column\", 'bigint' AS data_type, CAST(count(event_id) * 8 AS BIGINT) AS bytes FROM events",
        "SELECT 'ts', 'timestamp_ntz', CAST(count(ts) * 8 AS BIGINT) FROM events",
        "SELECT 'user_id', 'bigint', CAST(count(user_id) * 8 AS BIGINT) FROM events",
        "SELECT 'event_type', 'string', CAST(coalesce(sum(strlen(event_type)), 0) AS BIGINT) FROM events",
        "SELECT 'value', 'double', CAST(count(value) * 8 AS BIGINT) FROM events",
        "SELECT 'props', 'string', CAST(coalesce(sum(strlen(props)), 0) AS BIGINT) FROM events"])
    q["union_tables"] = f"SELECT {ev_cols} FROM events"
    q["to_long"] = _union([f"SELECT l_orderkey, l_linenumber, '{c}' AS feature, {c} + CAST(0 AS DOUBLE) AS value FROM lineitem"
                           for c in LCOLS])
    for name, kind in [("scale_minmax", "minmax"), ("scale_minmax_safe", "minmax_safe"),
                       ("scale_standard_samp", "standard_samp"), ("scale_standard_pop", "standard_pop"),
                       ("scale_robust", "robust"), ("scale_maxabs", "maxabs")]:
        q[name] = _scale_sql(kind)
    q["label_encode"] = ("SELECT event_id, event_type, CAST(dense_rank() OVER (ORDER BY event_type) - 1 AS INTEGER) "
                         "AS event_type_id FROM events")
    q["one_hot"] = "SELECT event_id, " + ", ".join(
        f"CAST(event_type = '{v}' AS INTEGER) AS event_type_{v}" for v in ["click", "error", "purchase", "signup", "view"]) + \
        " FROM events"
    q["frequency_encode"] = "SELECT event_id, count(*) OVER (PARTITION BY event_type) AS event_type FROM events"
    q["bool_to_int"] = ("SELECT event_id, CAST(event_type = 'click' AS INTEGER) AS is_click, "
                        "CAST(event_type = 'error' AS INTEGER) AS is_error FROM events")
    q["zscore_outliers"] = (f"SELECT event_id, value, {S('abs((value - m) / s)')} AS max_abs_z FROM events, "
                            "(SELECT avg(value) AS m, stddev_pop(value) AS s FROM events) WHERE abs((value - m) / s) > 3")
    q["rolling_mean_3"] = _rolling_sql([3], "mean", mp=1).replace("value_MA_3", "value_MA_3")
    q["rolling_mean"] = _rolling_sql(WINDOWS, "mean")
    q["rolling_var"] = _rolling_sql(WINDOWS, "var")
    q["rolling_by_user"] = _rolling_sql([5], "mean var", partition="user_id", digits=6)
    q["ema"] = _ema_sql(WINDOWS)
    q["rolling_null_key"] = _rolling_sql([5], "mean", partition="user_id", digits=6).replace(
        "FROM events", "FROM (SELECT event_id, ts, value, CASE WHEN event_id % 4 <> 0 THEN user_id END AS user_id FROM events)")
    qn = {w: D(1.0 - 2.0 / (w + 1.0)) for w in (10, 50)}
    q["ema_null_runs"] = f"""WITH RECURSIVE o AS (SELECT event_id, CASE WHEN event_id % 1000 < 20 THEN value END AS value,
    row_number() OVER (ORDER BY ts, event_id) - 1 AS rn FROM events),
r(rn, event_id, n10, d10, n50, d50) AS (
  SELECT rn, event_id, coalesce(value, CAST(0 AS DOUBLE)), CAST(CASE WHEN value IS NULL THEN 0 ELSE 1 END AS DOUBLE),
         coalesce(value, CAST(0 AS DOUBLE)), CAST(CASE WHEN value IS NULL THEN 0 ELSE 1 END AS DOUBLE) FROM o WHERE rn = 0
  UNION ALL
  SELECT o.rn, o.event_id, {", ".join(f"r.n{w} * {qn[w]} + coalesce(o.value, 0), r.d{w} * {qn[w]} + CASE WHEN o.value IS NULL THEN 0 ELSE 1 END" for w in qn)}
  FROM r JOIN o ON o.rn = r.rn + 1)
SELECT event_id, {", ".join(f"CASE WHEN d{w} > 0 THEN {S(f'n{w} / d{w}')} END AS value_EMA_{w}" for w in qn)} FROM r"""
    q["sign_changes"] = ("WITH s AS (SELECT event_id, ts, sign(value - (SELECT avg(value) FROM events)) AS s FROM events) "
                         "SELECT event_id, coalesce(s <> lag(s) OVER (ORDER BY ts, event_id), false) AS value_sign_change FROM s")
    q["features_statistical"] = _stat_features()
    q["features_time"] = (
        "WITH s AS (SELECT value, sign(value - (SELECT avg(value) FROM events)) AS s, ts, event_id FROM events), "
        "c AS (SELECT value, coalesce(s <> lag(s) OVER (ORDER BY ts, event_id), false) AS ch FROM s) "
        f"SELECT 'value' AS \"column\", {S('max(value)')} AS peak, {S('max(value) - min(value)')} AS peak_to_peak, "
        f"{S('count(*) FILTER (WHERE ch) / count(*)')} AS zero_crossing_rate, {S('sum(abs(value))')} AS signal_magnitude_area FROM c")
    q["features_spectral_closed"] = (
        f"SELECT 'value' AS \"column\", {S('count(value) * sum(value * value)')} AS spectral_energy, "
        f"{S('count(value) * var_pop(value) / (floor(count(value) / 2) + 1)')} AS mean_psd FROM events")
    q["spectrum_framed"] = _spectrum_framed()
    # the direct transform; the other half of the bins mirrors this one
    whole = """WITH o AS (SELECT coalesce(value, 0.0) AS x, row_number() OVER (ORDER BY ts, event_id) - 1 AS j, count(*) OVER () AS n FROM events),
kk AS (SELECT unnest({ks}) AS k),
z AS (SELECT k, any_value(n) AS n, sum(x * cos(2 * pi() * ((k * j) % n) / n)) AS re, sum(x * sin(2 * pi() * ((k * j) % n) / n)) AS im
      FROM o CROSS JOIN kk GROUP BY k),
m AS (SELECT k, n, sqrt(re * re + im * im) AS mag FROM z)"""
    q["spectrum_global"] = whole.format(ks="range(0, (SELECT count(*) // 2 + 1 FROM events))") + f""",
w AS (SELECT *, CASE WHEN k = 0 OR 2 * k = n THEN 1 ELSE 2 END AS c FROM m), t AS (SELECT sum(c * mag) AS tot FROM w)
SELECT 'value' AS "column", any_value(n)::BIGINT AS n, (SELECT k FROM m WHERE k >= 1 ORDER BY mag DESC, k LIMIT 1)::BIGINT AS dominant_k,
{S('sum(c * mag * mag)')} AS spectral_energy, {S('-sum(CASE WHEN mag > 0 THEN c * mag / tot * ln(mag / tot) ELSE 0 END)')} AS spectral_entropy
FROM w, t"""
    q["spectrum_bins"] = (whole.format(ks="[0, 1, 2, 3, 5, 8, 13, 50, 100, 333, 1000]")
                          + f" SELECT k::BIGINT AS k, {S('mag', 6)} AS mag FROM m WHERE k < n")
    q["stratified_split"] = f"WITH {EMB_SPLIT} SELECT vec_id, label, split FROM emb_s"
    q["stratified_subset"] = """WITH h AS (SELECT event_id, event_type,
        CAST(('0x' || substr(md5(CAST(event_id AS VARCHAR) || '|42'), 1, 13)) AS BIGINT) AS h FROM events),
c AS (SELECT event_type, count(*) AS nc FROM events GROUP BY 1),
t AS (SELECT sum(nc) AS n, least(5000, sum(nc)) AS nt FROM c),
a AS (SELECT c.event_type, t.nt * c.nc / t.n AS ex, floor(t.nt * c.nc / t.n) AS base, t.nt FROM c, t),
b AS (SELECT event_type, base + CASE WHEN row_number() OVER (ORDER BY ex - base DESC, event_type) <= nt - sum(base) OVER ()
                                THEN 1 ELSE 0 END AS take FROM a)
SELECT event_id, event_type FROM
  (SELECT h.*, b.take, row_number() OVER (PARTITION BY h.event_type ORDER BY h.h, h.event_id) - 1 AS rn
   FROM h JOIN b USING (event_type)) WHERE rn < take"""
    q["holdout_tail"] = ("SELECT event_id, CASE WHEN row_number() OVER (ORDER BY ts, event_id) - 1 >= "
                         "floor(count(*) OVER () * (1 - CAST(0.2 AS DOUBLE))) THEN 'val' ELSE 'train' END AS split FROM events")
    q["stratified_folds"] = ("SELECT doc_id, quality, CAST((row_number() OVER (PARTITION BY quality ORDER BY "
                             "CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR) || '|42'), 1, 13)) AS BIGINT), doc_id) - 1) % 5 "
                             "AS INTEGER) AS fold FROM labels")
    q["folds_null_class"] = q["stratified_folds"].replace(
        "FROM labels", "FROM (SELECT doc_id, CASE WHEN doc_id % 4 <> 0 THEN quality END AS quality FROM labels)")
    models = ", ".join(f"('{m}')" for m in ("logistic", "naive_bayes", "mlp_small"))
    q["model_roundtrip"] = ("SELECT model, CAST(ceil(0.2 * n) AS BIGINT) AS n, CAST(ceil(0.2 * n) AS BIGINT) AS n_equal "
                            f"FROM (SELECT count(*) AS n FROM embeddings), (VALUES {models}) m(model)")
    q["gnb_sql"] = f"WITH {GNB} SELECT vec_id, label, CAST(pred AS INTEGER) AS pred, {S('p_true')} AS p_true FROM gpred"
    q["knn_sql"] = f"WITH {KNN} SELECT vec_id, label, CAST(pred AS INTEGER) AS pred FROM knn"
    q["accuracy"] = f"WITH {GNB} SELECT {S('avg(CAST(label = pred AS DOUBLE))')} AS accuracy FROM gpred"
    q["weighted_prf"] = (f"WITH {GNB}, {per_class('gpred')} SELECT {S('accuracy')} AS accuracy, {S('precision')} AS precision, "
                         f"{S('recall')} AS recall, {S('f1')} AS f1 FROM ({weighted()})")
    q["confusion"] = (f"WITH {GNB}, {per_class('gpred')} SELECT a.c AS label, CAST(b.c AS INTEGER) AS pred, "
                      "CAST(coalesce(p.n, 0) AS BIGINT) AS count FROM pc_cls a CROSS JOIN pc_cls b "
                      "LEFT JOIN pc_pairs p ON p.y = a.c AND p.yhat = b.c")
    q["class_report"] = f"WITH {GNB}, {per_class('gpred')} " + f"""
SELECT CAST(class AS VARCHAR) AS "row", {S('precision')} AS precision, {S('recall')} AS recall, {S('f1')} AS f1, support FROM pc
UNION ALL SELECT 'accuracy', NULL, NULL, {S('sum(tp) / sum(support)')}, CAST(sum(support) AS BIGINT) FROM pc
UNION ALL SELECT 'macro avg', {S('avg(precision)')}, {S('avg(recall)')}, {S('avg(f1)')}, CAST(sum(support) AS BIGINT) FROM pc
UNION ALL SELECT 'weighted avg', {S('sum(precision * support) / sum(support)')}, {S('sum(recall * support) / sum(support)')},
  {S('sum(f1 * support) / sum(support)')}, CAST(sum(support) AS BIGINT) FROM pc"""
    q["log_loss"] = f"WITH {GNB} SELECT {S('avg(-ln(greatest(p_true, CAST(' + repr('1e-15') + ' AS DOUBLE))))')} AS log_loss, count(*) AS n FROM gpred"
    q["label_names_pred"] = f"WITH {GNB} SELECT vec_id, CAST(pred AS INTEGER) AS pred, 'class_' || CAST(pred AS VARCHAR) AS pred_name FROM gpred"
    mt = f"WITH {KNN}, {per_class('both_models', 'model')}, mt AS ({weighted('model')})"
    q["metric_table"] = (f"{mt} SELECT model, {S('accuracy')} AS accuracy, {S('precision')} AS precision, "
                         f"{S('recall')} AS recall, {S('f1')} AS f1 FROM mt")
    q["round_metrics"] = (f"{mt} SELECT model, metric, round_even(value, 4) AS value FROM "
                          "(UNPIVOT mt ON accuracy, precision, recall, f1 INTO NAME metric VALUE value)")
    q["best_model"] = (f"{mt} SELECT model, {S('accuracy')} AS accuracy, {S('precision')} AS precision, "
                       f"{S('recall')} AS recall, {S('f1')} AS f1 FROM mt ORDER BY accuracy DESC, model LIMIT 1")
    q["relative_change"] = (f"{mt}, b AS (SELECT accuracy AS ba, f1 AS bf FROM mt WHERE model = 'gaussian_nb') "
                            f"SELECT model, {S('CASE WHEN ba <> 0 THEN 100.0 * (accuracy - ba) / ba END')} AS accuracy_change_pct, "
                            f"{S('100.0 * (accuracy - ba)')} AS accuracy_change_pts, "
                            f"{S('CASE WHEN bf <> 0 THEN 100.0 * (f1 - bf) / bf END')} AS f1_change_pct, "
                            f"{S('100.0 * (f1 - bf)')} AS f1_change_pts FROM mt, b")
    q["fit_limits"] = ("SELECT p_partkey, " + S("p_retailprice * p_size / 16.0") + " AS size_kb, d.device, d.flash_kb, "
                       "CASE WHEN p_retailprice * p_size / 16.0 <= d.flash_kb THEN 'Suitable' ELSE 'Not Suitable' END AS status "
                       "FROM part, (VALUES ('Arduino Nano 33 BLE Sense', 1024), ('ESP32', 4096), ('Raspberry Pi Pico', 2048), "
                       "('STM32', 1024)) d(device, flash_kb)")
    q["grid_knn"] = "WITH " + _grid_knn()
    q["grid_knn_test"] = "WITH " + _grid_knn_test()
    q["quantize_symmetric"] = (f"SELECT vec_id, {S('s')} AS scale, d AS dim, CAST(CASE WHEN s = 0 THEN 0 ELSE "
                               "greatest(-127, least(127, round_even(x / s, 0))) END AS TINYINT) AS code FROM "
                               "(SELECT vec_id, CAST(unnest(range(len(embedding))) AS INTEGER) AS d, "
                               "CAST(unnest(embedding) AS DOUBLE) AS x, "
                               "list_max(list_transform(embedding, lambda v: abs(CAST(v AS DOUBLE)))) / 127 AS s FROM embeddings)")
    hq = "power(2, greatest(floor(log2(abs(x))), -14) - 10)"
    q["half_precision"] = (f"SELECT vec_id, dim, CASE WHEN x = 0 THEN x WHEN abs(round_even(x / {hq}, 0) * {hq}) > 65504 "
                           f"THEN CASE WHEN x > 0 THEN CAST('inf' AS DOUBLE) ELSE CAST('-inf' AS DOUBLE) END "
                           f"ELSE round_even(x / {hq}, 0) * {hq} END AS half FROM "
                           "(SELECT vec_id, CAST(unnest(range(len(embedding))) AS INTEGER) AS dim, "
                           "CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)")
    q["quantize_affine"] = _affine_codes()
    q["dequantize_error"] = _dequant_error()
    q["prune_magnitude"] = f"WITH {EMB_SPLIT}, {_prune_cte()} SELECT vec_id, dim, weight FROM pruned"
    q["sparsity"] = (f"WITH {EMB_SPLIT}, {_prune_cte()} SELECT label, count(*) AS n, count(*) FILTER (WHERE weight = 0) "
                     f"AS n_zero, {S('100.0 * avg(CAST(weight = 0 AS DOUBLE))')} AS sparsity_pct FROM pruned GROUP BY label")
    q["sparsity_sweep"] = _sparsity_sweep()
    ema = _ema_sql(WINDOWS).replace("WITH RECURSIVE ", "")
    q["engineered_features"] = (
        f"WITH RECURSIVE rl AS ({_rolling_sql(WINDOWS, 'mean')}), rv AS ({_rolling_sql(WINDOWS, 'var')}), "
        f"em AS (WITH RECURSIVE {ema}) SELECT * FROM rl JOIN rv USING (event_id) JOIN em USING (event_id)")
    q["variant_sizes"] = """WITH d AS (SELECT any_value(len(embedding)) AS dims, max(label) + 1 AS k FROM embeddings),
l AS (SELECT unnest([(dims + 1) * 16, 17 * 8, 9 * k])::BIGINT AS n FROM d),
v AS (SELECT 'float32' AS variant, n, 4 * n AS b FROM l UNION ALL SELECT 'float16', n, 2 * n FROM l
UNION ALL SELECT 'int8_dynamic', n, n + 8 FROM l UNION ALL SELECT 'int8_full', n, n + 16 FROM l
UNION ALL SELECT 'int8_full', 0, 16 * 4 UNION ALL SELECT 'pruned_70', n, (n + 7) // 8 + 4 * round_even(n * (1 - 0.7::DOUBLE), 0)::BIGINT FROM l)
SELECT variant, sum(n)::BIGINT AS n_weights, sum(b)::BIGINT AS size_bytes FROM v GROUP BY variant"""
    q["int8_inputs"] = f"""WITH {EMB_SPLIT},
r AS (SELECT least(min(x), 0) AS low, greatest(max(x), 0) AS high FROM emb_long JOIN emb_s USING (vec_id) WHERE split = 'train'),
p AS (SELECT *, round_even(-128 - low / scale, 0) AS zero FROM (
    SELECT low, CASE WHEN high > low THEN (high - low) / 255.0::DOUBLE ELSE 1.0::DOUBLE END AS scale FROM r)),
c AS (SELECT vec_id, least(greatest(round_even(x / scale + zero, 0), -128), 127)::BIGINT AS code
      FROM emb_long JOIN emb_s USING (vec_id), p WHERE split = 'test')
SELECT vec_id, sum(code)::BIGINT AS code_sum, count(*) FILTER (code IN (-128, 127)) AS n_at_end FROM c GROUP BY vec_id"""
    q["bundle_roundtrip"] = ("SELECT CAST(row_number() OVER (ORDER BY class_name) - 1 AS INTEGER) AS class_id, class_name, n, n AS n_equal "
                             "FROM (SELECT l_returnflag AS class_name, count(*) AS n FROM lineitem GROUP BY l_returnflag)")
    wide = [f"value_{k}_{w}" for k in ("MA", "VAR", "EMA") for w in WINDOWS]
    base = "(SELECT 8 * (count(event_id) + count(ts) + count(value)) FROM events)"
    q["engineered_size"] = (
        f"SELECT 'original' AS \"table\", 3 AS n_features, b::BIGINT AS bytes, b / 1024.0::DOUBLE AS kb FROM (SELECT {base} AS b) UNION ALL "
        f"SELECT 'engineered', {3 + len(wide)}, b::BIGINT, b / 1024.0::DOUBLE FROM (SELECT {base} + 8 * ("
        + " + ".join(f"count({c})" for c in wide) + f") AS b FROM ({q['engineered_features']}))")
    q["metrics_store"] = (f"{mt} SELECT model AS run, model, {S('accuracy')} AS accuracy, {S('precision')} AS precision, "
                          f"{S('recall')} AS recall, {S('f1')} AS f1 FROM mt")
    q["isolation_forest"] = "SELECT count(*) AS n, 0.02::DOUBLE AS outlier_share FROM lineitem"
    q["naive_bayes_ml"] = (f"WITH {GNB}, {per_class('gpred')} SELECT 'naive_bayes' AS model, {S('accuracy')} AS accuracy, "
                           f"{S('precision')} AS precision, {S('recall')} AS recall, {S('f1')} AS f1, "
                           "(SELECT count(DISTINCT label) * (2 * max(len(embedding)) + 1) FROM embeddings)::BIGINT AS n_params "
                           f"FROM ({weighted()})")
    ecols = ["event_id", "user_id", "value", "is_click"]
    ev4 = "(SELECT event_id, user_id, value, CAST(event_type = 'click' AS INTEGER) AS is_click FROM events)"
    q["correlation_all"] = _union([f"SELECT '{a}' AS col_a, '{b}' AS col_b, {S(f'corr({a}, {b})')} AS corr FROM {ev4}"
                                   for a in ecols for b in ecols])
    q["argmax_scores"] = (f"WITH {GNB}, sc AS (SELECT vec_id, list(jll ORDER BY cls) AS s FROM gjll GROUP BY vec_id) "
                          "SELECT vec_id, CAST(list_position(s, list_max(s)) - 1 AS INTEGER) AS argmax, "
                          "CAST(len(s) AS INTEGER) AS n_scores FROM sc")
    q["class_ids"] = ("SELECT CAST(row_number() OVER (ORDER BY l_returnflag) - 1 AS INTEGER) AS class_id, "
                      "l_returnflag AS class_name FROM (SELECT DISTINCT l_returnflag FROM lineitem)")
    q["smooth_3"] = ("SELECT event_id, " + S("avg(value) OVER (ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)")
                     + " AS value FROM events")
    return q
