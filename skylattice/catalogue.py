"""The registered queries of the survey operators and their SQL."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skylattice import schemas
from skylattice.functions import ids, orbits, photometry, sky, times
from skylattice.operators import aggregates, linkage
from skylattice.operators import relational as R
from skylattice.operators.moid import with_moid
from skylattice.operators.phase_fit import fit_hg12
from skylattice.plans import adapters as A
from skylattice.plans import catalogs
from skylattice.sinks import writers
from skylattice.sources import readers, schema_yaml

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
micro = A.micro


def query(sql: str | None = None):
    """Registers a function under its name, with its SQL if there is any."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def with_views(*views: str) -> str:
    return "WITH " + ",\n".join(views) + "\n"


def m(expression: str) -> str:
    return f"floor(({expression}) * 1e6::DOUBLE + 0.5::DOUBLE)::BIGINT"


# -- scans, projections, predicates


@query("SELECT event_id, user_id, value FROM events WHERE event_type = 'click' AND value > 10")
def scan_project_filter(spark, sf):
    return A.table(spark, sf, "events").where("event_type = 'click' AND value > 10").select("event_id", "user_id", "value")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus IS NOT NULL AND o_totalprice BETWEEN 1000 AND 200000")
def membership_and_range_filter(spark, sf):
    keep = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & F.col("o_orderstatus").isNotNull() & F.col("o_totalprice").between(1000, 200000)
    return A.table(spark, sf, "orders").where(keep).select("o_orderkey", "o_totalprice")


@query(f"SELECT p_partkey AS mpc_partkey, {m('p_retailprice * 1.085736::DOUBLE')} AS scaled, 'X05' AS stn FROM part")
def derived_and_constant_columns(spark, sf):
    p = A.table(spark, sf, "part").select(F.col("p_partkey").alias("partkey"), micro(F.col("p_retailprice") * photometry.MAG_ERR_FACTOR).alias("scaled"))
    return R.prefixed(p.select("partkey"), "mpc_").join(p, F.col("mpc_partkey") == F.col("partkey")).select("mpc_partkey", "scaled", F.lit("X05").alias("stn"))


@query("SELECT event_id, CASE WHEN event_type NOT IN ('', 'NULL', 'error') THEN event_type END AS event_type FROM events")
def null_token_columns(spark, sf):
    c = F.when(F.col("event_type") != "error", F.col("event_type")).otherwise("NULL")
    return A.table(spark, sf, "events").select("event_id", readers.null_tokens(c).alias("event_type"))


# -- joins


@query(with_views(A.SOURCES, A.DETECTIONS) + f"SELECT source_id, object_id, obssubid AS mpc_obssubid, provid AS mpc_provid, {m('mjd')} AS mjd FROM sources JOIN detections ON source_id = obssubid")
def association_inner_join(spark, sf):
    rows = R.associate(A.sources(spark, sf), A.detections(spark, sf), "source_id")
    return rows.select("source_id", "object_id", "mpc_obssubid", "mpc_provid", micro(F.col("mjd")).alias("mjd"))


@query(with_views(A.SOURCES, A.DETECTIONS, A.NUMBERED) + "SELECT obssubid AS mpc_obssubid, coalesce(provid, unpacked_primary) AS mpc_provid FROM detections LEFT JOIN numbered USING (permid)")
def permid_left_join_coalesce(spark, sf):
    return R.resolve_permanent(R.prefixed(A.detections(spark, sf), "mpc_"), A.numbered(spark, sf)).select("mpc_obssubid", "mpc_provid")


@query(
    with_views(A.SOURCES, A.DETECTIONS, A.NUMBERED, A.CURRENT)
    + "SELECT obssubid, p, prim AS designation, packed AS packed_designation FROM (SELECT obssubid, coalesce(provid, unpacked_primary) AS p FROM detections LEFT JOIN numbered USING (permid)) LEFT JOIN current_ids ON p = secondary"
)
def primary_designation_resolution(spark, sf):
    rows = R.resolve_primary(R.resolve_permanent(R.prefixed(A.detections(spark, sf), "mpc_"), A.numbered(spark, sf)), A.current(spark, sf))
    return rows.select(F.col("mpc_obssubid").alias("obssubid"), F.col("mpc_provid").alias("p"), "designation", "packed_designation")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size <= 5)")
def catalog_semi_join_ids(spark, sf):
    wanted = A.table(spark, sf, "part").where("p_size <= 5").select(F.col("p_partkey").alias("id"))
    return R.semi(A.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), wanted, "l_partkey")


@query(with_views(A.SOURCES, A.DETECTIONS) + "SELECT source_id, object_id FROM sources WHERE source_id NOT IN (SELECT obssubid FROM detections)")
def orphan_anti_join(spark, sf):
    return R.anti(A.sources(spark, sf).select("source_id", "object_id"), A.detections(spark, sf), "source_id", "obssubid")


@query(
    "SELECT o_orderkey, o_custkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM orders JOIN (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS rn FROM lineitem) l ON o_orderkey = l_orderkey AND rn = 1"
)
def argjoin_first_match(spark, sf):
    lines = A.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return R.first_match(lines, A.table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", ["l_linenumber", "l_partkey", "l_suppkey"])


_TJ = "CASE WHEN a > 0 AND a / 5.2044::DOUBLE * (1 - e * e) >= 0 THEN 5.2044::DOUBLE / a + 2 * cos(radians(i)) * sqrt(a / 5.2044::DOUBLE * (1 - e * e)) END"


@query(
    with_views(A.SOURCES, A.ORBITS)
    + f"SELECT object_id, n, coalesce({m('tj')}, 0) AS tisserand_micro, q IS NOT NULL AS matched FROM (SELECT object_id, count(*) AS n FROM sources GROUP BY 1) LEFT JOIN (SELECT object_id, q, {_TJ} AS tj FROM (SELECT *, q / (1 - e) AS a FROM orbits)) USING (object_id)"
)
def orbit_left_join_sentinels(spark, sf):
    tj = orbits.tisserand_jupiter(orbits.semi_major_axis(F.col("q"), F.col("e")), F.col("e"), F.col("i"))
    known = A.orbit_table(spark, sf).select("object_id", "q", tj.alias("tj"))
    joined = A.sources(spark, sf).groupBy("object_id").agg(F.count(F.lit(1)).alias("n")).join(known, "object_id", "left")
    return joined.select("object_id", "n", F.coalesce(micro(F.col("tj")), F.lit(0)).cast("long").alias("tisserand_micro"), F.col("q").isNotNull().alias("matched"))


@query(with_views(A.SOURCES, A.DETECTIONS) + "SELECT count(*) AS rows_before, n AS rows_after, count(*) = n AS ok FROM sources, (SELECT count(*) AS n FROM sources JOIN detections ON source_id = obssubid) GROUP BY n")
def cardinality_check(spark, sf):
    s = A.sources(spark, sf)
    return R.check_cardinality(s, R.associate(s, A.detections(spark, sf), "source_id"))


# -- aggregates

_STATS = f"count(*) AS n, {m('min(mjd)')} AS first_mjd, {m('max(mjd) - min(mjd)')} AS arc, min(flux) AS flux_min, max(flux) AS flux_max, {m('quantile_cont(flux, 0.5)')} AS flux_median"


@query(with_views(A.SOURCES) + f"SELECT object_id, {_STATS} FROM sources GROUP BY object_id")
def object_observation_stats(spark, sf):
    s = aggregates.object_statistics(A.sources(spark, sf), "object_id", "mjd", "flux")
    return s.select("object_id", F.col("nObs").alias("n"), micro(F.col("first_time")).alias("first_mjd"), micro(F.col("arc")).alias("arc"), F.col("fluxMin").alias("flux_min"), F.col("fluxMax").alias("flux_max"), micro(F.col("fluxMedian")).alias("flux_median"))


_BANDS_N = ", ".join(f"count(*) FILTER (band = '{b}') AS {b}_nobs" for b in schemas.BANDS)


@query(with_views(A.SOURCES) + f"SELECT object_id, {_BANDS_N} FROM sources GROUP BY object_id")
def band_pivot_counts(spark, sf):
    return aggregates.band_counts(A.sources(spark, sf), "object_id").withColumnsRenamed({f"{b}_nObs": f"{b}_nobs" for b in schemas.BANDS})


@query(with_views(A.SOURCES) + "SELECT object_id, " + ", ".join(f"min(phase) FILTER (band = '{b}') AS {b}_phase_min, max(phase) FILTER (band = '{b}') AS {b}_phase_max" for b in schemas.BANDS) + " FROM sources GROUP BY object_id")
def band_phase_range(spark, sf):
    r = aggregates.band_range(A.sources(spark, sf), "object_id", "phase")
    return r.withColumnsRenamed({f"{b}_phase{k}": f"{b}_phase_{k.lower()}" for b in schemas.BANDS for k in ("Min", "Max")})


@query(
    with_views(A.SOURCES, A.ORBITS)
    + f"SELECT object_id, n, first_mjd, arc, flux_min, flux_max, flux_median, {', '.join(f'{b}_nobs' for b in schemas.BANDS)}, phase_min, phase_max, {m('tj')} AS tisserand FROM (SELECT object_id, {_STATS}, {_BANDS_N}, min(phase) AS phase_min, max(phase) AS phase_max FROM sources GROUP BY object_id) LEFT JOIN (SELECT object_id, {_TJ} AS tj FROM (SELECT *, q / (1 - e) AS a FROM orbits)) USING (object_id)"
)
def object_catalog(spark, sf):
    """The flagship's aggregate form: statistics, band counts and phases of each object in one grouping, and its orbit."""
    rows = A.sources(spark, sf)
    grouped = rows.groupBy("object_id").agg(
        F.count(F.lit(1)).alias("n"),
        micro(F.min("mjd")).alias("first_mjd"),
        micro(F.max("mjd") - F.min("mjd")).alias("arc"),
        F.min("flux").alias("flux_min"),
        F.max("flux").alias("flux_max"),
        micro(F.median("flux")).alias("flux_median"),
        *[F.count_if(F.col("band") == b).alias(f"{b}_nobs") for b in schemas.BANDS],
        F.min("phase").alias("phase_min"),
        F.max("phase").alias("phase_max"),
    )
    tj = orbits.tisserand_jupiter(orbits.semi_major_axis(F.col("q"), F.col("e")), F.col("e"), F.col("i"))
    return grouped.join(A.orbit_table(spark, sf).select("object_id", micro(tj).alias("tisserand")), "object_id", "left")


@query(with_views(A.SOURCES) + "SELECT count(DISTINCT object_id) AS objects, count(DISTINCT band) AS bands FROM sources")
def distinct_objects(spark, sf):
    return A.sources(spark, sf).agg(F.count_distinct("object_id").alias("objects"), F.count_distinct("band").alias("bands"))


@query(with_views(A.SOURCES) + "SELECT band, count(*) AS n FROM sources GROUP BY band")
def band_histogram(spark, sf):
    return aggregates.value_counts(A.sources(spark, sf), "band")


@query(with_views(A.SOURCES) + "SELECT object_id, band, n FROM (SELECT object_id, band, count(*) AS n, row_number() OVER (PARTITION BY object_id ORDER BY count(*) DESC, band) AS r FROM sources GROUP BY object_id, band) WHERE r = 1")
def modal_band(spark, sf):
    return aggregates.modal(A.sources(spark, sf), "object_id", "band")


_FLAGS = "flagged AS (SELECT object_id, bit_or(CASE WHEN k < 5 THEN 1 ELSE 0 END + CASE WHEN flux > 100 THEN 2 ELSE 0 END + CASE WHEN band = 'u' THEN 4 ELSE 0 END + CASE WHEN k > 95 THEN 8 ELSE 0 END)::INT AS flags FROM sources GROUP BY object_id)"


def _flagged(spark, sf):
    flags = F.lit(0)
    for bit, when in ((1, F.col("k") < 5), (2, F.col("flux") > 100), (4, F.col("band") == "u"), (8, F.col("k") > 95)):
        flags = R.set_flag(flags, bit, when)
    return A.sources(spark, sf).groupBy("object_id").agg(F.bit_or(flags).alias("flags"))


@query(with_views(A.SOURCES, _FLAGS) + "SELECT object_id, flags, flags & 4 <> 0 AS has_u FROM flagged")
def flag_bits(spark, sf):
    return _flagged(spark, sf).select("object_id", "flags", R.has_flag(F.col("flags"), 4).alias("has_u"))


@query(with_views(A.SOURCES, _FLAGS) + "SELECT a, b, count(*) FILTER (flags & a <> 0 AND flags & b <> 0) AS n FROM flagged, (VALUES (1), (2), (4), (8)) x(a), (VALUES (1), (2), (4), (8)) y(b) WHERE a <= b GROUP BY a, b")
def flag_cooccurrence(spark, sf):
    return aggregates.cooccurrence(_flagged(spark, sf), "flags", (1, 2, 4, 8))


@query(with_views(A.SOURCES) + f"SELECT least(floor((phase - lo) / ((hi - lo) / 10)), 9)::INT AS bin, count(*) AS n, {m('avg(k)')} AS mean FROM sources, (SELECT min(phase) AS lo, max(phase) AS hi FROM sources) GROUP BY 1")
def binned_mean(spark, sf):
    return aggregates.binned_mean(A.sources(spark, sf), "phase", "k", 10).withColumn("mean", micro(F.col("mean")))


@query(with_views(A.SOURCES) + "SELECT least(floor(n / 1::DOUBLE), 99)::INT AS bin, count(*) AS n FROM (SELECT object_id, band, count(*) AS n FROM sources GROUP BY 1, 2) WHERE n BETWEEN 0 AND 100 GROUP BY 1")
def fixed_histogram(spark, sf):
    sizes = A.sources(spark, sf).groupBy("object_id", "band").agg(F.count(F.lit(1)).alias("size"))
    return aggregates.histogram(sizes, "size", 0.0, 100.0, 100)


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(spark, sf):
    return R.check_unique(A.table(spark, sf, "lineitem"), "l_orderkey", "l_linenumber")


@query("SELECT c_custkey AS id, c_name AS name, 'customer' AS kind FROM customer UNION ALL SELECT s_suppkey, s_name, 'supplier' FROM supplier")
def union_all_catalogs(spark, sf):
    c = A.table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.lit("customer").alias("kind"))
    s = A.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.lit("supplier").alias("kind"))
    return catalogs.union_all([c, s])


@query("SELECT k AS object_id, count(*) FILTER (new) AS runs FROM (SELECT user_id AS k, lag(user_id) OVER (ORDER BY event_id) IS DISTINCT FROM user_id AS new FROM events) GROUP BY k")
def grouped_contiguity(spark, sf):
    return R.contiguity(A.table(spark, sf, "events").select(F.col("user_id").alias("object_id"), "event_id"), "object_id", "event_id")


@query("SELECT count(*) AS n, sum(o_orderkey)::BIGINT AS key_sum, count(DISTINCT o_custkey) AS customers FROM orders")
def key_checksum(spark, sf):
    return A.table(spark, sf, "orders").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("key_sum"), F.count_distinct("o_custkey").alias("customers"))


@query('SELECT \'p_name\' AS "column", sum(strlen(p_name))::BIGINT AS bytes, max(length(p_name))::INT AS longest FROM part UNION ALL SELECT \'p_brand\', sum(strlen(p_brand))::BIGINT, max(length(p_brand))::INT FROM part UNION ALL SELECT \'p_type\', sum(strlen(p_type))::BIGINT, max(length(p_type))::INT FROM part')
def text_sizes(spark, sf):
    return aggregates.text_sizes(A.table(spark, sf, "part"))


@query(with_views(A.ORBITS) + "SELECT count(*) FILTER (NOT (i BETWEEN 0 AND 30)) AS i_outside, count(*) FILTER (NOT (node BETWEEN 0 AND 360)) AS node_outside FROM orbits")
def orbit_range_check(spark, sf):
    return R.check_ranges(A.orbit_table(spark, sf), i=(0, 30), node=(0, 360))


# -- order, sets


@query("SELECT s_nationkey AS k FROM supplier INTERSECT SELECT c_nationkey FROM customer WHERE c_acctbal > 9000")
def key_intersection(spark, sf):
    return A.table(spark, sf, "supplier").select(F.col("s_nationkey").alias("k")).intersect(A.table(spark, sf, "customer").where("c_acctbal > 9000").select("c_nationkey"))


@query("SELECT c_nationkey AS k FROM customer EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 8000")
def key_difference(spark, sf):
    return A.table(spark, sf, "customer").select(F.col("c_nationkey").alias("k")).distinct().exceptAll(A.table(spark, sf, "supplier").where("s_acctbal > 8000").select("s_nationkey").distinct())


@query("SELECT event_id, user_id, value FROM events ORDER BY value DESC, event_id LIMIT 25")
def brightest_sources(spark, sf):
    return A.table(spark, sf, "events").select("event_id", "user_id", "value").orderBy(F.desc("value"), "event_id").limit(25)


@query("SELECT DISTINCT o_custkey, o_orderpriority FROM orders")
def distinct_rows(spark, sf):
    return A.table(spark, sf, "orders").select("o_custkey", "o_orderpriority").distinct()


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY md5(o_orderkey::VARCHAR), o_orderkey LIMIT 100")
def exact_row_sample(spark, sf):
    return R.exact_sample(A.table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", 100)


# -- photometry


def _spline_sql(n: int) -> str:
    """The piecewise cubics as CASE text for the oracle; x is the phase in radians."""
    knots, coefficients = photometry.SPLINES[n]
    parts = []
    for k in reversed(range(len(coefficients))):
        c = [f"({v!r})::DOUBLE" for v in coefficients[k].tolist()]
        t = f"(x - ({float(knots[k])!r})::DOUBLE)"
        parts.append((f"WHEN x >= ({float(knots[k])!r})::DOUBLE " if k else "ELSE ") .replace("ELSE ", "WHEN true ") + f"THEN (({c[0]} * {t} + {c[1]}) * {t} + {c[2]}) * {t} + {c[3]}")
    inner = "CASE " + " ".join(parts) + " END"
    if n == 3:
        return f"CASE WHEN x > pi() / 6 THEN 0::DOUBLE ELSE {inner} END"
    return f"CASE WHEN x < ({float(knots[0])!r})::DOUBLE THEN 1 - x * {'6 / pi()' if n == 1 else '(9 / (5 * pi()))'} ELSE {inner} END"


_PHI = with_views(
    A.SOURCES,
    "h AS (SELECT source_id, phase, radians(phase) AS x, 15::DOUBLE + object_id % 5 AS h, 0.1::DOUBLE + (object_id % 7) / 10::DOUBLE AS g FROM sources)",
    f"f AS (SELECT *, {_spline_sql(1)} AS p1, {_spline_sql(2)} AS p2, {_spline_sql(3)} AS p3 FROM h)",
)


def _phased(spark, sf):
    s = A.sources(spark, sf)
    return s.select("source_id", "phase", F.radians("phase").alias("x"), (F.lit(15.0) + F.col("object_id") % 5).alias("h"), (F.lit(0.1) + (F.col("object_id") % 7) / F.lit(10.0)).alias("g"))


@query(with_views(A.SOURCES) + f"SELECT source_id, {m('CASE WHEN flux > 0 THEN 31.4::DOUBLE - 2.5::DOUBLE * log10(flux) END')} AS mag, {m('CASE WHEN flux <> 0 THEN 1.085736::DOUBLE * flux_err / flux END')} AS mag_err FROM sources")
def flux_to_mag(spark, sf):
    return A.sources(spark, sf).select("source_id", micro(photometry.njy_to_mag(F.col("flux"))).alias("mag"), micro(photometry.njy_err_to_mag_err(F.col("flux"), F.col("flux_err"))).alias("mag_err"))


@query(_PHI + f"SELECT source_id, {m('h - 2.5::DOUBLE * log10(0.3::DOUBLE * p1 + 0.2::DOUBLE * p2 + 0.5::DOUBLE * p3)')} AS mag FROM f")
def hg1g2_model(spark, sf):
    return _phased(spark, sf).select("source_id", micro(photometry.hg1g2(F.col("x"), F.col("h"), F.lit(0.3), F.lit(0.2))).alias("mag"))


@query(
    _PHI
    + f"SELECT source_id, {m('h - 2.5::DOUBLE * log10(g1 * p1 + g2 * p2 + (1 - g1 - g2) * p3)')} AS mag FROM (SELECT *, CASE WHEN g >= 0.2::DOUBLE THEN 0.9529::DOUBLE * g + 0.02162::DOUBLE ELSE 0.7527::DOUBLE * g + 0.06164::DOUBLE END AS g1, CASE WHEN g >= 0.2::DOUBLE THEN -0.6125::DOUBLE * g + 0.5572::DOUBLE ELSE -0.9612::DOUBLE * g + 0.6270::DOUBLE END AS g2 FROM f)"
)
def hg12_model(spark, sf):
    return _phased(spark, sf).select("source_id", micro(photometry.hg12(F.col("x"), F.col("h"), F.col("g"))).alias("mag"))


@query(_PHI + f"SELECT source_id, {m('h - 2.5::DOUBLE * log10(g1 * p1 + g2 * p2 + (1 - g1 - g2) * p3)')} AS mag FROM (SELECT *, 0.84293649::DOUBLE * g AS g1, 0.53513350::DOUBLE - 0.53513350::DOUBLE * g AS g2 FROM f)")
def hg12star_model(spark, sf):
    return _phased(spark, sf).select("source_id", micro(photometry.hg12_star(F.col("x"), F.col("h"), F.col("g"))).alias("mag"))


@query(
    _PHI
    + f"SELECT source_id, {m('h - 2.5::DOUBLE * log10((1 - 0.15::DOUBLE) * (w * (1 - 0.986::DOUBLE * s) + (1 - w) * exp(-3.332::DOUBLE * power(t, 0.631::DOUBLE))) + 0.15::DOUBLE * (w * (1 - 0.238::DOUBLE * s) + (1 - w) * exp(-1.862::DOUBLE * power(t, 1.218::DOUBLE))))')} AS mag FROM (SELECT *, exp(-90.56::DOUBLE * t * t) AS w, sin(x) / (0.119::DOUBLE + 1.341::DOUBLE * sin(x) - 0.754::DOUBLE * sin(x) * sin(x)) AS s FROM (SELECT *, tan(x / 2) AS t FROM f))"
)
def hg_model_bowell(spark, sf):
    return _phased(spark, sf).select("source_id", micro(photometry.hg_bowell(F.col("x"), F.col("h"), F.lit(0.15))).alias("mag"))


@query(
    _PHI
    + f"SELECT source_id, {m('h + 5 * log10(2.7::DOUBLE * 1.9::DOUBLE) - 2.5::DOUBLE * log10((1 - 0.15::DOUBLE) * exp(-3.33::DOUBLE * power(t, 0.63::DOUBLE)) + 0.15::DOUBLE * exp(-1.87::DOUBLE * power(t, 1.22::DOUBLE)))')} AS vmag FROM (SELECT *, tan(radians(phase) / 2) AS t FROM f)"
)
def hg_v_mag(spark, sf):
    return _phased(spark, sf).select("source_id", micro(photometry.hg_v_mag(F.col("h"), F.lit(0.15), F.lit(2.7), F.lit(1.9), F.col("phase"))).alias("vmag"))


# -- geometry


_SEP = "degrees(atan2(sqrt(power(cos(q) * sin(d), 2) + power(cos(p) * sin(q) - sin(p) * cos(q) * cos(d), 2)), sin(p) * sin(q) + cos(p) * cos(q) * cos(d)))"


@query(with_views(A.SOURCES, A.SKY) + f"SELECT source_id, {m(_SEP)} AS separation FROM (SELECT source_id, radians(120::DOUBLE - ra) AS d, radians(dec) AS p, radians(20::DOUBLE) AS q FROM sky)")
def great_circle_separation(spark, sf):
    return A.sky_positions(spark, sf).select("source_id", micro(sky.separation(F.col("ra"), F.col("dec"), F.lit(120.0), F.lit(20.0))).alias("separation"))


def _rotated(matrix) -> str:
    rows = [" + ".join(f"{c} * ({float(v)!r})::DOUBLE" for c, v in zip("abc", row, strict=True)) for row in matrix]
    return (
        with_views(A.SOURCES, A.SKY)
        + f"SELECT source_id, {m('((degrees(atan2(y, x)) % 360) + 360) % 360')} AS lon, {m('degrees(asin(greatest(-1::DOUBLE, least(1::DOUBLE, z))))')} AS lat FROM (SELECT source_id, {rows[0]} AS x, {rows[1]} AS y, {rows[2]} AS z FROM (SELECT source_id, cos(radians(dec)) * cos(radians(ra)) AS a, cos(radians(dec)) * sin(radians(ra)) AS b, sin(radians(dec)) AS c FROM sky))"
    )


@query(_rotated(sky.ECLIPTIC))
def ecliptic_coords(spark, sf):
    lon, lat = sky.ecliptic(F.col("ra"), F.col("dec"))
    return A.sky_positions(spark, sf).select("source_id", micro(lon).alias("lon"), micro(lat).alias("lat"))


@query(_rotated(sky.GALACTIC))
def galactic_coords(spark, sf):
    lon, lat = sky.galactic(F.col("ra"), F.col("dec"))
    return A.sky_positions(spark, sf).select("source_id", micro(lon).alias("lon"), micro(lat).alias("lat"))


@query(
    with_views(A.SOURCES, A.SKY)
    + f"SELECT source_id, {m('CASE WHEN c > 0 THEN degrees(cos(p) * sin(d) / c) END')} AS xi, {m('CASE WHEN c > 0 THEN degrees((cos(p0) * sin(p) - sin(p0) * cos(p) * cos(d)) / c) END')} AS eta FROM (SELECT *, sin(p0) * sin(p) + cos(p0) * cos(p) * cos(d) AS c FROM (SELECT source_id, radians(ra - 120) AS d, radians(dec) AS p, radians(20::DOUBLE) AS p0 FROM sky WHERE abs(ra - 120) < 60 AND abs(dec) < 60))"
)
def tangent_plane_offsets(spark, sf):
    s = A.sky_positions(spark, sf).where((F.abs(F.col("ra") - 120) < 60) & (F.abs("dec") < 60))
    x, y = sky.tangent_offsets(F.col("ra"), F.col("dec"), F.lit(120.0), F.lit(20.0))
    return s.select("source_id", micro(x).alias("xi"), micro(y).alias("eta"))


@query(
    with_views(A.SOURCES, A.SKY)
    + f"SELECT source_id, {m('((((k / 1000::DOUBLE + 180) % 360) + 360) % 360 - 180) * cos(radians(dec)) * 3600')} AS d_ra, {m('k / 2000::DOUBLE * 3600')} AS d_dec FROM sky"
)
def observed_minus_predicted(spark, sf):
    s = A.sky_positions(spark, sf).withColumns({"d": F.col("k") / F.lit(1000.0)})
    d_ra, d_dec, _ = sky.oc_offsets(F.col("d"), F.col("k") / F.lit(2000.0), F.lit(0.0), F.lit(0.0))
    return s.select("source_id", micro(sky.wrap_difference(F.col("d")) * F.cos(F.radians("dec")) * 3600).alias("d_ra"), micro(d_dec).alias("d_dec"))


@query(
    with_views(A.SOURCES)
    + f"SELECT source_id, {m('CASE WHEN s > 0 THEN degrees(acos(greatest(-1::DOUBLE, least(1::DOUBLE, -(ox * dx + oy * dy + oz * dz) / s)))) END')} AS phase_angle FROM (SELECT *, sqrt(ox * ox + oy * oy + oz * oz) * sqrt(dx * dx + dy * dy + dz * dz) AS s FROM (SELECT *, 0.9::DOUBLE - ox AS dx, 0.3::DOUBLE - oy AS dy, 0.1::DOUBLE - oz AS dz FROM (SELECT source_id, 1.5::DOUBLE + k / 50::DOUBLE AS ox, phase / 10 AS oy, (source_id % 10) / 10::DOUBLE AS oz FROM sources)))"
)
def phase_angle_vectors(spark, sf):
    s = A.sources(spark, sf)
    obj = (F.lit(1.5) + F.col("k") / F.lit(50.0), F.col("phase") / 10, (F.col("source_id") % 10) / F.lit(10.0))
    return s.select("source_id", micro(sky.phase_angle(obj, (F.lit(0.9), F.lit(0.3), F.lit(0.1)))).alias("phase_angle"))


@query(
    with_views(A.SOURCES)
    + f"SELECT source_id, {m('r')} AS range, {m('(x * vx + y * vy) / r')} AS range_rate, {m('sqrt(vx * vx + vy * vy) * 149597870.7::DOUBLE / 86400')} AS speed_kms FROM (SELECT *, sqrt(x * x + y * y) AS r FROM (SELECT source_id, 1 + k / 100::DOUBLE AS x, phase / 20 AS y, flux / 1e5::DOUBLE AS vx, k / 1e4::DOUBLE AS vy FROM sources))"
)
def vector_ranges(spark, sf):
    x = (1 + F.col("k") / F.lit(100.0), F.col("phase") / 20, F.lit(0.0))
    v = (F.col("flux") / F.lit(1e5), F.col("k") / F.lit(1e4), F.lit(0.0))
    return A.sources(spark, sf).select("source_id", micro(sky.norm(x)).alias("range"), micro(sky.range_rate(x, v)).alias("range_rate"), micro(sky.norm(v) * sky.AU_KM / sky.DAY_S).alias("speed_kms"))


@query(
    with_views(A.SOURCES, A.SKY, "sun AS (SELECT source_id, ra, dec, radians(280.460::DOUBLE + 0.9856474::DOUBLE * n + 1.915::DOUBLE * sin(g) + 0.020::DOUBLE * sin(2 * g)) AS l, radians(23.439::DOUBLE - 0.0000004::DOUBLE * n) AS e FROM (SELECT *, radians(357.528::DOUBLE + 0.9856003::DOUBLE * n) AS g FROM (SELECT *, mjd - 51544.5::DOUBLE AS n FROM sky)))")
    + f"SELECT source_id, {m(_SEP)} AS elongation FROM (SELECT source_id, atan2(cos(e) * sin(l), cos(l)) - radians(ra) AS d, radians(dec) AS p, asin(sin(e) * sin(l)) AS q FROM sun)"
)
def solar_elongation(spark, sf):
    return A.sky_positions(spark, sf).select("source_id", micro(sky.elongation(F.col("ra"), F.col("dec"), F.col("mjd"))).alias("elongation"))


@query(with_views(A.ORBITS) + f"SELECT object_id, {m(_TJ)} AS tisserand, {m('(((argperi - 400) % 360) + 360) % 360')} AS wrapped FROM (SELECT *, q / (1 - e) AS a FROM orbits)")
def tisserand_jupiter(spark, sf):
    tj = orbits.tisserand_jupiter(orbits.semi_major_axis(F.col("q"), F.col("e")), F.col("e"), F.col("i"))
    return A.orbit_table(spark, sf).select("object_id", micro(tj).alias("tisserand"), micro(sky.wrap(F.col("argperi") - 400)).alias("wrapped"))


_N = 64
_E = orbits.EARTH_J2000
_P = "cos(o) * cos(w) - sin(o) * sin(w) * cos(i), sin(o) * cos(w) + cos(o) * sin(w) * cos(i), sin(w) * sin(i)".split(", ")
_Q = "-cos(o) * sin(w) - sin(o) * cos(w) * cos(i), -sin(o) * sin(w) + cos(o) * cos(w) * cos(i), cos(w) * sin(i)".split(", ")


def _positions_sql(source: str) -> str:
    xyz = ", ".join(f"a * (1 - e * e) / (1 + e * cos(f)) * (cos(f) * ({p}) + sin(f) * ({q})) AS {c}" for p, q, c in zip(_P, _Q, "xyz", strict=True))
    return f"SELECT id, {xyz} FROM (SELECT *, (k + 0.5::DOUBLE) / {_N} * 2 * pi() AS f FROM {source}, (SELECT unnest(range({_N})) AS k))"


@query(
    with_views(
        A.ORBITS,
        "el AS (SELECT object_id AS id, q / (1 - e) AS a, e, radians(i) AS i, radians(node) AS o, radians(argperi) AS w FROM orbits)",
        f"ea AS (SELECT 0 AS id, {_E[0]!r}::DOUBLE AS a, {_E[1]!r}::DOUBLE AS e, radians({_E[2]!r}::DOUBLE) AS i, radians({_E[3]!r}::DOUBLE) AS o, radians({_E[4]!r}::DOUBLE) AS w)",
        f"pa AS ({_positions_sql('ea')})",
        f"pb AS ({_positions_sql('el')})",
    )
    + f"SELECT pb.id AS object_id, {m('sqrt(min(power(pa.x - pb.x, 2) + power(pa.y - pb.y, 2) + power(pa.z - pb.z, 2)))')} AS distance FROM pa, pb GROUP BY pb.id"
)
def moid_level0_grid(spark, sf):
    """The coarse grid as a plan: each orbit meets a grid of fixed size, 64 x 64 anomalies."""
    anomalies = spark.range(_N).select(((F.col("id") + 0.5) / _N * 2 * math.pi).alias("f"))

    def place(df: DataFrame, tag: str) -> DataFrame:
        i, o, w = (F.radians(c) for c in ("i", "node", "argperi"))
        p = (F.cos(o) * F.cos(w) - F.sin(o) * F.sin(w) * F.cos(i), F.sin(o) * F.cos(w) + F.cos(o) * F.sin(w) * F.cos(i), F.sin(w) * F.sin(i))
        q = (-F.cos(o) * F.sin(w) - F.sin(o) * F.cos(w) * F.cos(i), -F.sin(o) * F.sin(w) + F.cos(o) * F.cos(w) * F.cos(i), F.cos(w) * F.sin(i))
        r = F.col("a") * (1 - F.col("e") * F.col("e")) / (1 + F.col("e") * F.cos("f"))
        return df.crossJoin(F.broadcast(anomalies)).select("object_id", *[(r * (F.cos("f") * p[k] + F.sin("f") * q[k])).alias(f"{tag}{c}") for k, c in enumerate("xyz")])

    earth = spark.createDataFrame([(0, *map(float, _E))], "object_id long, a double, e double, i double, node double, argperi double")
    other = A.orbit_table(spark, sf).withColumn("a", orbits.semi_major_axis(F.col("q"), F.col("e")))
    pairs = place(other, "b").crossJoin(F.broadcast(place(earth, "a").drop("object_id")))
    gap = sum((F.pow(F.col(f"a{c}") - F.col(f"b{c}"), F.lit(2)) for c in "yz"), F.pow(F.col("ax") - F.col("bx"), F.lit(2)))
    return pairs.groupBy("object_id").agg(micro(F.sqrt(F.min(gap))).alias("distance"))


@query()
def moid_refined(spark, sf):
    return with_moid(A.orbit_table(spark, sf))


# -- ids, times, text


@query(
    "SELECT p_partkey, packed, " + " + ".join(f"(ascii(substr(s, {k + 1}, 1))::BIGINT << {8 * k})" for k in range(8)) + " AS packed_id FROM (SELECT *, lpad(packed, 8, ' ') AS s FROM (SELECT p_partkey, 'K' || lpad((p_partkey % 100)::VARCHAR, 2, '0') || 'A' || p_partkey::VARCHAR AS packed FROM part))"
)
def packed_designation_id(spark, sf):
    return _packed(spark, sf).select("p_partkey", "packed", ids.packed_to_long(F.col("packed")).alias("packed_id"))


def _packed(spark, sf):
    key = F.col("p_partkey")
    return A.table(spark, sf, "part").select("p_partkey", F.concat(F.lit("K"), F.lpad((key % 100).cast("string"), 2, "0"), F.lit("A"), key.cast("string")).alias("packed"))


@query("SELECT p_partkey, substr(packed, 1, 8) AS unpacked FROM (SELECT p_partkey, 'K' || lpad((p_partkey % 100)::VARCHAR, 2, '0') || 'A' || p_partkey::VARCHAR AS packed FROM part)")
def unpack_designation_id(spark, sf):
    return _packed(spark, sf).select("p_partkey", ids.long_to_packed(ids.packed_to_long(F.col("packed"))).alias("unpacked"))


@query(with_views(A.SOURCES) + "SELECT source_id, floor((mjd - 40587) * 86400e6::DOUBLE + 0.5::DOUBLE)::BIGINT - 37000000 AS utc_micros, floor(mjd)::BIGINT AS night FROM sources")
def mjd_to_utc(spark, sf):
    return A.sources(spark, sf).select("source_id", times.mjd_tai_to_utc_micros(F.col("mjd")).alias("utc_micros"), times.night(F.col("mjd")).alias("night"))


@query(
    "SELECT o_orderkey, epoch_us(o_orderdate) + 43200000000 - 1000000 * CASE WHEN o_orderdate < DATE '1996-01-01' THEN 29 WHEN o_orderdate < DATE '1997-07-01' THEN 30 WHEN o_orderdate < DATE '1999-01-01' THEN 31 ELSE 32 END AS utc_micros FROM orders"
)
def noon_tai_to_utc(spark, sf):
    """Over several ranges of leap seconds."""
    noon = times.mjd_of(F.col("o_orderdate")) + F.lit(0.5)
    return A.table(spark, sf, "orders").select("o_orderkey", times.mjd_tai_to_utc_micros(noon).alias("utc_micros"))


@query(
    with_views(A.SOURCES)
    + "SELECT object_id::VARCHAR || '|' || strftime(make_timestamp((us // 1000) * 1000), '%Y-%m-%dT%H:%M:%S.%g') || 'Z|' || k::VARCHAR || '|' || band || '|X05|CCD|Gaia2' AS line FROM (SELECT *, floor((mjd - 40587) * 86400e6::DOUBLE + 0.5::DOUBLE)::BIGINT - 37000000 AS us FROM sources)"
)
def ades_report_rows(spark, sf):
    s = A.sources(spark, sf).withColumnRenamed("mjd", "mjd_tai").withColumns({"ra": F.lit(None), "dec": F.lit(None), "ra_sigma": F.lit(None), "dec_sigma": F.lit(None), "mag": F.col("k"), "mag_sigma": F.lit(None)})
    rows = writers.report_rows(s, station="X05")
    return rows.select(F.concat_ws("|", "trkSub", "obsTime", F.col("mag").cast("string"), "band", "stn", "mode", "astCat").alias("line"))


@query("SELECT CAST(json_extract_string(props, '$.k') AS INT) AS k, count(*) AS n FROM events GROUP BY 1")
def json_property_counts(spark, sf):
    parsed = F.from_json("props", "k int")
    return A.table(spark, sf, "events").groupBy(parsed["k"].alias("k")).agg(F.count(F.lit(1)).alias("n"))


# -- linkage and windows


def _placed(spark, sf):
    """Sources with positions a few tenths of an arcsecond apart, so that the distance decides."""
    return A.sources(spark, sf).withColumns({"ra": (F.col("source_id") % 5) * F.lit(0.0002), "dec": F.lit(0.0)})


_PAIRS = with_views(
    A.SOURCES,
    "p AS (SELECT object_id, source_id, mjd, floor(mjd)::BIGINT AS night, (source_id % 5) * 0.0002::DOUBLE AS ra FROM sources)",
    "t AS (SELECT object_id, a.night, count(*) AS n_pairs FROM p AS a JOIN p AS b USING (object_id) WHERE a.night = b.night AND (a.mjd < b.mjd OR (a.mjd = b.mjd AND a.source_id < b.source_id)) AND a.mjd >= b.mjd - 0.0625::DOUBLE AND 2 * degrees(asin(sin(radians(abs(a.ra - b.ra)) / 2))) * 3600 >= 1 GROUP BY 1, 2)",
)


@query(_PAIRS + "SELECT object_id, night, n_pairs FROM t")
def nightly_tracklets(spark, sf):
    return linkage.tracklets(_placed(spark, sf))


_NIGHTS = _PAIRS.rstrip() + ", f AS (SELECT object_id, min(night) AS discovery_night FROM (SELECT *, count(*) OVER (PARTITION BY object_id ORDER BY night RANGE BETWEEN 14 PRECEDING AND CURRENT ROW) AS k FROM t) WHERE k >= 3 GROUP BY 1) "


@query(_NIGHTS + "SELECT object_id, discovery_night FROM f")
def rolling_15_night_discovery(spark, sf):
    return linkage.discoveries(nightly_tracklets(spark, sf))


@query(_NIGHTS + "SELECT object_id, CASE WHEN discovery_night IS NULL THEN 2048 ELSE 0 END AS flags FROM (SELECT DISTINCT object_id FROM sources) LEFT JOIN f USING (object_id)")
def unlinked_flags(spark, sf):
    objects = A.sources(spark, sf).select("object_id").distinct().withColumn("flags", F.lit(0))
    return linkage.flag_unlinked(objects, rolling_15_night_discovery(spark, sf))


@query(with_views(A.SOURCES) + "SELECT source_id, object_id, rank() OVER (PARTITION BY object_id, floor(mjd)::BIGINT ORDER BY phase)::INT AS distance_rank FROM sources")
def distance_rank(spark, sf):
    rows = A.sources(spark, sf).withColumn("night", times.night(F.col("mjd")))
    return linkage.closeness_rank(rows, ["object_id", "night"], "phase", "distance_rank").select("source_id", "object_id", "distance_rank")


# -- fits and whole pipelines


@query(with_views(A.SOURCES) + f"SELECT object_id, band, {m('regr_slope(k, phase)')} AS slope, {m('regr_intercept(k, phase)')} AS intercept, count(*) AS n FROM sources GROUP BY object_id, band HAVING count(DISTINCT phase) > 1")
def linear_phase_fit_per_band(spark, sf):
    g = A.sources(spark, sf).groupBy("object_id", "band").agg(micro(F.regr_slope("k", "phase")).alias("slope"), micro(F.regr_intercept("k", "phase")).alias("intercept"), F.count(F.lit(1)).alias("n"), F.count_distinct("phase").alias("d"))
    return g.where("d > 1").drop("d")


@query()
def hg12_fit_per_band(spark, sf):
    rows = A.phase_curve(spark, sf)
    return fit_hg12(rows, ["object_id", "band"], F.col("source_id"), F.col("mag"), F.col("mag_err"), F.col("phase"))


def _survey(spark, sf):
    """dia sources, detections, identifications and orbits with consistent designations, from the driver's tables."""
    s = A.sky_positions(spark, sf)
    name = F.concat(F.lit("P"), F.col("object_id").cast("string"))
    dia = s.select(F.col("source_id").alias("diaSourceId"), F.col("object_id").alias("ssObjectId"), F.col("mjd").alias("midpointMjdTai"), "ra", "dec", (F.col("k") / F.lit(100.0)).alias("extendedness"), "band", (F.col("flux") * 1000).alias("psfFlux"), (F.col("flux_err") * 1000).alias("psfFluxErr"))
    obs = s.select(
        F.col("source_id").alias("obssubid"), F.when(F.col("source_id") % 3 != 0, name).alias("provid"), F.col("object_id").cast("string").alias("permid"), "ra", "dec", times.mjd_tai_to_utc(F.col("mjd")).cast("timestamp_ntz").alias("obstime")
    )
    objects = s.select("object_id").distinct()
    numbered = objects.select(F.col("object_id").cast("string").alias("permid"), name.alias("unpacked_primary_provisional_designation"))
    current = objects.select(name.alias("unpacked_secondary_provisional_designation"), name.alias("unpacked_primary_provisional_designation"), F.concat(F.lit("K"), F.col("object_id").cast("string")).alias("packed_primary_provisional_designation"))
    orbit = A.orbit_table(spark, sf).select(
        name.alias("unpacked_primary_provisional_designation"), F.concat(F.lit("K"), F.col("object_id").cast("string")).alias("packed_primary_provisional_designation"), orbits.semi_major_axis(F.col("q"), F.col("e")).alias("a"),
        "q", "e", "i", "node", "argperi", (F.col("object_id") * 17 % 360).cast("double").alias("mean_anomaly"), F.lit(60000.0).alias("epoch_mjd"), F.lit(17.5).alias("h"), F.lit(0.15).alias("g"),
    )
    return dia, obs, numbered, current, orbit


@query()
def sssource_full(spark, sf):
    return catalogs.build_sssource(*_survey(spark, sf))


_ECLIPTIC_GALACTIC = [[" + ".join(f"({v!r})::DOUBLE * {axis}" for v, axis in zip(row, "abc", strict=True)) for row in matrix] for matrix in (sky.ECLIPTIC, sky.GALACTIC)]
_PACKED = " + ".join(f"(ascii(substr(lpad('K' || object_id::VARCHAR, 8, ' '), {k + 1}, 1))::BIGINT << {8 * k})" for k in range(8))


def _lon_lat(lon: str, lat: str, rows: list[str]) -> str:
    return f"{m(f'((degrees(atan2({rows[1]}, {rows[0]})) % 360) + 360) % 360')} AS {lon}, {m(f'degrees(asin(greatest(-1::DOUBLE, least(1::DOUBLE, {rows[2]}))))')} AS {lat}"


@query(
    with_views(A.SOURCES, A.SKY, A.ORBITS)
    + f"""SELECT source_id AS source, {_PACKED} AS object, 'P' || object_id::VARCHAR AS designation, {_lon_lat("ecl_lon", "ecl_lat", _ECLIPTIC_GALACTIC[0])}, {_lon_lat("gal_lon", "gal_lat", _ECLIPTIC_GALACTIC[1])}
FROM (SELECT *, cos(radians(dec)) * cos(radians(ra)) AS a, cos(radians(dec)) * sin(radians(ra)) AS b, sin(radians(dec)) AS c FROM sky) JOIN orbits USING (object_id)"""
)
def sssource_identity_and_place(spark, sf):
    """The per-source catalogue's columns that need no ephemeris."""
    built = catalogs.build_sssource(*_survey(spark, sf), check=False)
    places = {"ecl_lon": "eclLambda", "ecl_lat": "eclBeta", "gal_lon": "galLon", "gal_lat": "galLat"}
    return built.select(F.col("diaSourceId").alias("source"), F.col("ssObjectId").alias("object"), "designation", *[micro(F.col(c)).alias(n) for n, c in places.items()])


@query(
    with_views(A.SOURCES, A.ORBITS)
    + f"""SELECT {_PACKED} AS object, 'P' || object_id::VARCHAR AS designation, count(*)::INT AS n_obs, {m("min(mjd)")} AS first_mjd, {m("max(mjd) - min(mjd)")} AS arc,
min(k) AS ext_min, max(k) AS ext_max, {m("median(k / 100::DOUBLE)")} AS ext_median, {", ".join(f"count(*) FILTER (band = '{b}')::INT AS {b}_n_obs" for b in schemas.BANDS)}
FROM sources JOIN orbits USING (object_id) GROUP BY object_id"""
)
def ssobject_aggregates(spark, sf):
    """The per-object catalogue's aggregates, through the association and the per-source catalogue."""
    dia, obs, numbered, current, orbit = _survey(spark, sf)
    sss = catalogs.build_sssource(dia, obs, numbered, current, orbit, check=False)
    rows = catalogs.object_aggregates(catalogs.observations(sss, dia))
    hundredths = [F.round(F.col(f"extendedness{c}") * 100).cast("int").alias(f"ext_{c.lower()}") for c in ("Min", "Max")]
    return rows.select(
        F.col("ssObjectId").alias("object"), "designation", F.col("nObs").alias("n_obs"), micro(F.col("firstObservationMjdTai")).alias("first_mjd"), micro(F.col("arc")).alias("arc"),
        *hundredths, micro(F.col("extendednessMedian")).alias("ext_median"), *[F.col(f"{b}_nObs").alias(f"{b}_n_obs") for b in schemas.BANDS],
    )


@query()
def ssobject_full(spark, sf):
    dia, obs, numbered, current, orbit = _survey(spark, sf)
    return catalogs.build_ssobject(catalogs.build_sssource(dia, obs, numbered, current, orbit, check=False), dia, orbit)


@query(with_views(A.SOURCES) + "SELECT count(*) AS pairs, count(*) FILTER ((source_id % 5) * 4e-7 * 3600 > 0.005 OR source_id % 7 = 0) AS violations FROM sources")
def association_check(spark, sf):
    dia, obs, *_ = _survey(spark, sf)
    # every fifth detection is moved by more than is allowed, every seventh is reported a second late
    late = F.when(F.col("obssubid") % 7 == 0, F.expr("INTERVAL 1 SECOND")).otherwise(F.expr("INTERVAL 0 SECOND"))
    obs = obs.withColumns({"dec": F.col("dec") + (F.col("obssubid") % 5) * 4e-7, "obstime": F.col("obstime") + late})
    return catalogs.association_check(R.associate(dia, obs)).select("pairs", "violations")


@query()
def schema_ddl(spark, sf):
    rows = [(name, schema_yaml.ddl(name, schema)) for name, schema in schemas.TABLES.items()]
    return spark.createDataFrame(rows, "table_name string, ddl string")


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, grouping(l_returnflag)::INT AS all_flags FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def rollup_counts(spark, sf):
    return A.table(spark, sf, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.grouping("l_returnflag").cast("int").alias("all_flags"))


@query(with_views(A.SOURCES) + "SELECT source_id, object_id, k, sum(k) OVER (PARTITION BY object_id ORDER BY mjd, source_id)::BIGINT AS running, lag(band) OVER (PARTITION BY object_id ORDER BY mjd, source_id) AS before FROM sources")
def running_totals(spark, sf):
    w = Window.partitionBy("object_id").orderBy("mjd", "source_id")
    return A.sources(spark, sf).select("source_id", "object_id", "k", F.sum("k").over(w).alias("running"), F.lag("band").over(w).alias("before"))
