"""The same questions in SQL, for comparison. Written from the definitions, not from
the Spark plans."""

from __future__ import annotations

MONEY = "DECIMAL(18,2)"


def r(expr: str, name: str, places: int = 6) -> str:
    return f"round({expr}, {places}) + 0.0 AS {name}"


def yearly(source: str, value: str, blank: str) -> str:
    """Nation rows, some values blanked; the code of one nation is in no list."""
    return f"""
      SELECT n_name AS entity,
             CASE WHEN n_nationkey = 9 THEN 'AGG_' || n_name ELSE n_name END AS code, year,
             CASE WHEN NOT ({blank}) THEN {value} END AS {value}
      FROM {source} JOIN nation ON nationkey = n_nationkey"""


# Each part may use the ones above it.
PARTS = {
    "dim_country": """
      SELECT n_name AS iso3, n_name AS name,
             CASE WHEN n_regionkey = 3 THEN 1 ELSE 0 END AS is_eu,
             CASE WHEN n_name IN ('NATION_1','NATION_12','NATION_20') THEN 1 ELSE 0 END
               AS faostat_fallback,
             CAST(row_number() OVER (ORDER BY n_name) AS INTEGER) AS country_id
      FROM nation""",
    "dim_partner": """
      SELECT country_id, iso3, name, faostat_fallback FROM dim_country WHERE is_eu = 0""",
    "flows": f"""
      SELECT c_nationkey, s_nationkey, year(o_orderdate) AS order_year,
             year(l_shipdate) AS ship_year, sum(l_quantity) AS qty,
             sum(CAST(l_tax AS {MONEY})) AS tax, count(*) AS n
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
      JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
      GROUP BY ALL""",
    "made": """
      SELECT s_nationkey AS nationkey, ship_year AS year, sum(qty) AS production_tonnes
      FROM flows GROUP BY ALL""",
    "used": """
      SELECT c_nationkey AS nationkey, order_year AS year,
             CAST(sum(qty) AS BIGINT) AS consumption_tones
      FROM flows GROUP BY ALL""",
    "bought": """
      SELECT c_nationkey AS nationkey, order_year AS year, sum(qty) AS import_tonnes
      FROM flows WHERE c_nationkey <> s_nationkey GROUP BY ALL""",
    "earned": f"""
      SELECT c_nationkey AS nationkey, year(o_orderdate) AS year,
             CAST(sum(CAST(o_totalprice AS {MONEY})) AS DOUBLE) / count(*) AS gdp_change_forecast
      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL""",
    "production": yearly("made", "production_tonnes", "(nationkey + year) % 7 = 0"),
    "consumption": yearly("used", "consumption_tones", "(nationkey + year) % 5 = 0"),
    "imports": yearly("bought", "import_tonnes", "(3 * nationkey + year) % 11 = 0"),
    "gdp": yearly("earned", "gdp_change_forecast", "(nationkey + year) % 4 = 0"),
    "fact_production": """
      SELECT country_id, CAST(year AS INTEGER) AS year, production_tonnes
      FROM production JOIN dim_country ON code = iso3""",
    "fact_consumption": """
      SELECT country_id, CAST(year AS INTEGER) AS year, CAST(consumption_tones AS BIGINT) AS consumption_tones
      FROM consumption JOIN dim_country ON code = iso3""",
    "fact_import": """
      SELECT country_id, CAST(year AS INTEGER) AS year, import_tonnes
      FROM imports JOIN dim_country ON code = iso3""",
    "market_raw": """
      SELECT country_id, year, production_tonnes, import_tonnes, consumption_tones,
             consumption_tones - production_tonnes AS import_gap
      FROM fact_production FULL JOIN fact_import USING (country_id, year)
      FULL JOIN fact_consumption USING (country_id, year)""",
    "market": """
      SELECT *,
        (import_gap - min(import_gap) OVER y)
          / nullif(max(import_gap) OVER y - min(import_gap) OVER y, 0) AS import_gap_normalized,
        (import_tonnes - min(import_tonnes) OVER y)
          / nullif(max(import_tonnes) OVER y - min(import_tonnes) OVER y, 0)
          AS import_size_normalized
      FROM market_raw WINDOW y AS (PARTITION BY year)""",
    "forecast_raw": """
      SELECT country_id, avg(gdp_change_forecast) AS gdp_forecast_growth_avg,
             CAST(count(*) AS BIGINT) AS n_years
      FROM gdp JOIN dim_country ON code = iso3
      WHERE gdp_change_forecast IS NOT NULL GROUP BY country_id""",
    "forecast": """
      SELECT *, (gdp_forecast_growth_avg - min(gdp_forecast_growth_avg) OVER ())
        / nullif(max(gdp_forecast_growth_avg) OVER () - min(gdp_forecast_growth_avg) OVER (), 0)
        AS gdp_growth_forecast_normalized
      FROM forecast_raw""",
    "recent": """
      SELECT * FROM (
        SELECT *, max(year) OVER (PARTITION BY country_id) AS max_year FROM fact_import)
      WHERE year >= greatest(max_year - 5, 1996)""",
    "placed": """
      SELECT *, row_number() OVER (PARTITION BY country_id ORDER BY year) AS up,
             row_number() OVER (PARTITION BY country_id ORDER BY year DESC) AS down
      FROM recent""",
    "cagr_raw": """
      SELECT country_id,
        pow(max(CASE WHEN down = 1 THEN import_tonnes END)
              / nullif(max(CASE WHEN up = 1 THEN import_tonnes END), 0),
            1.0 / nullif(max(year) - min(year), 0)) - 1 AS import_CAGR,
        min(year) AS first_year, max(year) AS last_year, max(max_year) AS max_year,
        CAST(count(import_tonnes) AS BIGINT) AS n_periods_non_null
      FROM placed GROUP BY country_id HAVING count(import_tonnes) >= 5""",
    "cagr_cut": """
      SELECT *, CASE WHEN import_CAGR IS NOT NULL THEN greatest(import_CAGR,
        (SELECT quantile_disc(import_CAGR, 0.06) FROM cagr_raw)) END AS cut FROM cagr_raw""",
    "cagr": """
      SELECT * EXCLUDE (cut), (cut - min(cut) OVER ())
        / nullif(max(cut) OVER () - min(cut) OVER (), 0) AS import_CAGR_normalized
      FROM cagr_cut""",
    "growth": "SELECT * FROM forecast FULL JOIN cagr USING (country_id)",
    "tariff": """
      SELECT CASE WHEN c.n_nationkey = 11 THEN 'UNLISTED' ELSE c.n_name END AS reporter,
             s.n_name AS partner, order_year AS year, CAST(sum(tax) AS DOUBLE) / sum(n)
             AS tariff_average
      FROM flows JOIN nation c ON c_nationkey = c.n_nationkey
      JOIN nation s ON s_nationkey = s.n_nationkey
      GROUP BY c.n_nationkey, c.n_name, s.n_name, order_year""",
    "tariff_pairs": """
      SELECT a.country_id AS reporting_country_id, b.country_id AS partner_country_id,
             CAST(year AS INTEGER) AS year, tariff_average
      FROM tariff LEFT JOIN dim_country a ON reporter = a.iso3
      LEFT JOIN dim_country b ON partner = b.iso3 WHERE b.is_eu <> 0""",
    "tariff_raw": """
      SELECT reporting_country_id AS country_id, avg(tariff_average) AS tariff_avg
      FROM tariff_pairs GROUP BY reporting_country_id""",
    "tariff_cut": """
      SELECT *, least(tariff_avg, (SELECT quantile_disc(tariff_avg, 0.98) FROM tariff_raw)) AS cut
      FROM tariff_raw""",
    "tariff_level": """
      SELECT country_id, tariff_avg, (cut - min(cut) OVER ())
        / nullif(max(cut) OVER () - min(cut) OVER (), 0) AS tariff_avg_normalized
      FROM tariff_cut""",
    "raw_distance": """
      SELECT a.n_name AS iso_o, b.n_name AS iso_d,
        CAST(CASE WHEN a.n_nationkey <> b.n_nationkey
             THEN abs(a.n_nationkey - b.n_nationkey) * 100 + 7 END AS DOUBLE) AS dist
      FROM (SELECT DISTINCT c_nationkey, s_nationkey FROM flows)
      JOIN nation a ON c_nationkey = a.n_nationkey JOIN nation b ON s_nationkey = b.n_nationkey""",
    "distance_level": """
      SELECT o.country_id AS country_id_o, d.country_id AS country_id_d, dist,
        (dist - min(dist) OVER ()) / nullif(max(dist) OVER () - min(dist) OVER (), 0)
        AS dist_normalized
      FROM raw_distance JOIN dim_country o ON iso_o = o.iso3 JOIN dim_country d ON iso_d = d.iso3
      WHERE iso_o = 'NATION_3' AND d.is_eu = 0""",
    "barriers": """
      SELECT t.country_id IS NULL AND d.country_id_d IS NULL AS unknown,
             coalesce(t.country_id, d.country_id_d) AS country_id, tariff_avg,
             tariff_avg_normalized, dist, dist_normalized
      FROM tariff_level t FULL JOIN distance_level d ON t.country_id = d.country_id_d""",
    "usable": """
      SELECT max(year) AS y FROM market
      WHERE import_tonnes IS NOT NULL AND import_gap IS NOT NULL""",
    "latest": """
      SELECT p.country_id, max(import_tonnes) AS import_size, max(import_gap) AS import_gap,
             max(import_size_normalized) AS size_n, max(import_gap_normalized) AS gap_n
      FROM dim_partner p LEFT JOIN market m ON m.country_id = p.country_id
        AND m.year = (SELECT y FROM usable)
          - CASE WHEN p.faostat_fallback = 1 THEN 1 ELSE 0 END
      GROUP BY p.country_id""",
    "indicators": """
      SELECT p.country_id, p.name, l.import_size, l.import_gap, size_n, gap_n,
             import_CAGR, gdp_forecast_growth_avg, import_CAGR_normalized AS cagr_n,
             gdp_growth_forecast_normalized AS gdp_n, tariff_avg, dist,
             tariff_avg_normalized AS tariff_n, dist_normalized AS dist_n
      FROM dim_partner p LEFT JOIN latest l USING (country_id)
      LEFT JOIN growth g USING (country_id) LEFT JOIN barriers b USING (country_id)""",
    "scenarios": """
      SELECT * FROM (VALUES ('default', 0.9::DOUBLE, 0.7::DOUBLE, 0.5::DOUBLE, 0.5::DOUBLE, 0.7::DOUBLE),
        ('even', 0.5, 0.5, 0.5, 0.5, 0.5), ('demand only', 1.0, 0.5, 0.5, 1.0, 1.0),
        ('ease only', 0.0, 0.5, 0.25, 0.5, 0.5), ('growth first', 0.6, 0.2, 0.75, 0.3, 0.4))
        AS s(scenario, w1, w21, w22, w31, w32)""",
    "level3": """
      SELECT *, CASE WHEN coalesce(cagr_n, gdp_n) IS NOT NULL
          THEN coalesce(w31 * cagr_n, 0) + coalesce((1 - w31) * gdp_n, 0) END AS growth_metric,
        CASE WHEN coalesce(size_n, gap_n) IS NOT NULL
          THEN coalesce(w32 * size_n, 0) + coalesce((1 - w32) * gap_n, 0) END AS market_metric
      FROM indicators, scenarios""",
    "level2": """
      SELECT *, CASE WHEN coalesce(market_metric, growth_metric) IS NOT NULL
          THEN coalesce(w21 * market_metric, 0) + coalesce((1 - w21) * growth_metric, 0) END
          AS demand_metric,
        CASE WHEN tariff_n IS NOT NULL AND dist_n IS NOT NULL
               THEN 1 - (w22 * tariff_n + (1 - w22) * dist_n)
             WHEN tariff_n IS NOT NULL THEN 0.5 - w22 * tariff_n
             WHEN dist_n IS NOT NULL THEN 0.5 - (1 - w22) * dist_n END AS ease_metric
      FROM level3""",
    "scored": """
      SELECT *, round(CASE WHEN coalesce(demand_metric, ease_metric) IS NOT NULL
          THEN coalesce(w1 * demand_metric, 0) + coalesce((1 - w1) * ease_metric, 0) END, 4)
          AS market_score
      FROM level2""",
    "names": """
      SELECT * FROM (VALUES ('Import size', 1, 'Demand', 'Trade', 'Import size'),
        ('Import gap', 2, 'Demand', 'Trade', 'Import gap'), ('CAGR', 3, 'Demand', 'Growth', 'CAGR'),
        ('GDP forecast', 4, 'Demand', 'Growth', 'GDP forecast'), ('Tariff', 5, 'Barriers', 'Tariff', ''),
        ('Distance', 6, 'Barriers', 'Distance', ''))
        AS i(indicator, indicator_order, level1, level2, parameter)""",
    "weights": """
      SELECT scenario, indicator, indicator_order, level1, level2, parameter, w1, w21,
        CASE indicator_order WHEN 1 THEN w1 * w21 * w32 WHEN 2 THEN w1 * w21 * (1 - w32)
          WHEN 3 THEN w1 * (1 - w21) * w31 WHEN 4 THEN w1 * (1 - w21) * (1 - w31)
          WHEN 5 THEN (1 - w1) * w22 ELSE (1 - w1) * (1 - w22) END AS exact_weight
      FROM scenarios, names""",
    "breakdown": """
      SELECT country_id, name, scenario, indicator, indicator_order, level1, level2, parameter,
        w1, w21, value_normalized, round(exact_weight, 4) AS weight,
        round(exact_weight, 4) * value_normalized AS weighted_value, value_text
      FROM (SELECT i.country_id, i.name, w.*,
        CASE indicator_order WHEN 1 THEN size_n WHEN 2 THEN gap_n WHEN 3 THEN cagr_n
          WHEN 4 THEN gdp_n WHEN 5 THEN 1 - tariff_n ELSE 1 - dist_n END AS value_normalized,
        CASE indicator_order WHEN 1 THEN coalesce(plain(round(import_size, 2)), '') || ' tonnes'
          WHEN 2 THEN coalesce(plain(round(import_gap, 2)), '') || ' tonnes'
          WHEN 3 THEN coalesce(plain(round(import_CAGR, 2) * 100), '') || '%'
          WHEN 4 THEN coalesce(plain(round(gdp_forecast_growth_avg, 2)), '') || '%'
          WHEN 5 THEN coalesce(plain(round(tariff_avg, 2) * 100), '') || '%'
          ELSE coalesce(plain(round(dist, 2)), '') || ' km' END AS value_text
        FROM indicators i, weights w)""",
    "trade": f"""
      SELECT CASE l_returnflag WHEN 'R' THEN 'export' WHEN 'A' THEN 'import' ELSE 'other' END
               AS flow,
        CAST(year(l_shipdate) AS INTEGER) AS marketing_year,
        CAST(month(l_shipdate) AS INTEGER) AS month_order,
        sn.n_name AS member_state, cn.n_name || ' ' || c_mktsegment AS partner,
        p_type AS product_group, CAST(l_partkey AS VARCHAR) AS product_code,
        l_quantity AS product_weight_in_tonnes, l_quantity * 1.25 AS carcase_weight_in_tonnes,
        CAST(l_extendedprice AS {MONEY}) AS value_in_thousand_euro
      FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
      JOIN nation sn ON s_nationkey = sn.n_nationkey JOIN orders ON l_orderkey = o_orderkey
      JOIN customer ON o_custkey = c_custkey JOIN nation cn ON c_nationkey = cn.n_nationkey""",
    "trade_rows": """
      SELECT t.partner, flow, product_group,
        sum(product_weight_in_tonnes) AS product_weight_in_tonnes,
        sum(carcase_weight_in_tonnes) AS carcase_weight_in_tonnes,
        CAST(sum(value_in_thousand_euro) AS DOUBLE) AS value_in_thousand_euro,
        member_state || '-' || marketing_year || '-' || lpad(CAST(month_order AS VARCHAR), 2, '0')
          AS trade_key, max_last AS last_month
      FROM trade t JOIN (SELECT partner, max(month_order) AS max_last FROM trade
        WHERE marketing_year = (SELECT max(marketing_year) FROM trade) GROUP BY partner) m
        ON t.partner = m.partner
      GROUP BY member_state, t.partner, flow, marketing_year, month_order, product_group,
        max_last""",
    "prices": """
      SELECT CAST(begin AS DATE) AS begin_date, CAST(begin + INTERVAL 6 DAY AS DATE) AS end_date,
        CAST(n_nationkey AS VARCHAR) AS member_state_code, n_name AS member_state_name,
        event_type AS pig_class, price, '€/100 kg' AS unit,
        CAST(week(begin) AS INTEGER) AS week_number,
        CAST(year(CAST(begin AS DATE) + 3) AS INTEGER) AS year,
        year(CAST(begin AS DATE) + 3) || lpad(CAST(week(begin) AS VARCHAR), 2, '0') AS year_week,
        CAST(month(CAST(begin AS DATE) + 3) AS INTEGER) AS month_number,
        DATE '2001-12-31' AS created, DATE '2001-12-31' AS modified
      FROM (SELECT user_id % 25 AS k, date_trunc('week', ts) AS begin, event_type,
              max(value) AS price FROM events GROUP BY ALL)
      JOIN nation ON k = n_nationkey""",
    "price_rows": """
      SELECT pig_class, price, unit, week_number,
        member_state_name || '-' || year || '-' || lpad(CAST(month_number AS VARCHAR), 2, '0')
          AS prices_key
      FROM prices WHERE pig_class = 'purchase'""",
    "monthly": """
      SELECT CAST(s_nationkey AS VARCHAR) AS member_state_code, n_name AS member_state_name,
        strftime(l_shipdate, '%B') AS month, CAST(year(l_shipdate) AS INTEGER) AS year,
        month(l_shipdate) AS month_number, CAST(count(*) AS DOUBLE) AS heads,
        sum(l_quantity) / count(*) AS kg_per_head, sum(l_quantity) AS tonnes
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
      JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL""",
    "ranked": """
      SELECT member_state_name, rank() OVER (ORDER BY sum(tonnes) DESC) AS rnk
      FROM monthly WHERE year >= 1997 GROUP BY member_state_name""",
    "state_groups": """
      SELECT member_state_name,
        CASE WHEN rnk <= 7 THEN member_state_name ELSE 'Other' END AS country_group
      FROM ranked""",
    "production_rows": """
      SELECT heads, kg_per_head, tonnes * 1000 AS tonnes,
        member_state_name || '-' || year || '-' || lpad(CAST(month_number AS VARCHAR), 2, '0')
          AS prod_key, country_group
      FROM monthly JOIN state_groups USING (member_state_name)""",
    "bridge": """
      SELECT k AS bridge_key, split_part(k, '-', 1) AS member_state, right(k, 7) AS year_month
      FROM (SELECT trade_key AS k FROM trade_rows UNION SELECT prices_key FROM price_rows
            UNION SELECT prod_key FROM production_rows)""",
    "dirty": """
      SELECT l_orderkey, l_linenumber,
        CASE WHEN l_partkey % 13 <> 0 THEN l_partkey END AS l_partkey,
        l_quantity - 5 AS l_quantity FROM lineitem""",
}


def plain_text(expr: str, scale: int = 10) -> str:
    """Number without exponent and trailing zeros."""
    return f"regexp_replace(CAST(CAST({expr} AS DECIMAL(38,{scale})) AS VARCHAR), '\\.?0+$', '')"


def _expand_plain(sql: str) -> str:
    """Replace the shorthand plain(x) by the full text expression."""
    out, at = "", 0
    while (start := sql.find("plain(", at)) >= 0:
        depth, end = 1, start + len("plain(")
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        out += sql[at:start] + plain_text(sql[start + len("plain(") : end - 1])
        at = end
    return out + sql[at:]


def with_parts(select: str, upto: str) -> str:
    """The statement after all parts up to the named one."""
    names = list(PARTS)
    used = names[: names.index(upto) + 1]
    parts = ",\n".join(f"{n} AS ({PARTS[n]})" for n in used)
    return _expand_plain(f"WITH {parts}\n{select}")


def _blank_sum(a: str, b: str) -> str:
    return f"CASE WHEN coalesce({a}, {b}) IS NOT NULL THEN coalesce({a}, 0) + coalesce({b}, 0) END"


_EVER_IN_TOP = f"""
  SELECT DISTINCT country_id, name FROM (
    SELECT country_id, name, rank() OVER (PARTITION BY wd, wt, wf, wc, ws ORDER BY score DESC) AS place FROM (
      SELECT *, round({_blank_sum('wd * demand', '(1 - wd) * ease')}, 4) AS score FROM (
        SELECT *, {_blank_sum('wt * size', '(1 - wt) * growth')} AS demand FROM (
          SELECT *, {_blank_sum('ws * size_n', '(1 - ws) * gap_n')} AS size,
            {_blank_sum('wc * cagr_n', '(1 - wc) * gdp_n')} AS growth,
            CASE WHEN tariff_n IS NOT NULL AND dist_n IS NOT NULL THEN 1.0 ELSE 0.5 END
              - {_blank_sum('wf * tariff_n', '(1 - wf) * dist_n')} AS ease
          FROM indicators, (SELECT i / 4.0 AS wd FROM range(5) AS t(i)), (SELECT i / 4.0 AS wt FROM range(5) AS t(i)),
            (SELECT i / 4.0 AS wf FROM range(5) AS t(i)), (SELECT i / 4.0 AS wc FROM range(5) AS t(i)),
            (SELECT i / 4.0 AS ws FROM range(5) AS t(i)))))
    WHERE score IS NOT NULL) WHERE place <= 12"""


def _rounded(columns: list[str], plain: list[str], source: str, upto: str, where: str = "") -> str:
    shown = [*plain, *[r(c, c) for c in columns]]
    return with_parts(f"SELECT {', '.join(shown)} FROM {source} {where}", upto)


def _dq(checks: list[tuple[str, str, str]]) -> str:
    rows = [
        f"SELECT {i} AS position, '{rule}' AS rule, '{column}' AS \"column\", "
        f"CAST({count} AS BIGINT) AS unexpected_count, "
        "(SELECT count(*) FROM dirty) AS element_count"
        for i, (rule, column, count) in enumerate(checks)
    ]
    return with_parts(
        f"SELECT *, unexpected_count = 0 AS success FROM ({' UNION ALL '.join(rows)})", "dirty"
    )


def _count(condition: str) -> str:
    return f"(SELECT count(*) FROM dirty WHERE {condition})"


def _repeated(a: str, b: str) -> str:
    return (
        f"(SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM dirty "
        f"WHERE {a} IS NOT NULL OR {b} IS NOT NULL GROUP BY {a}, {b} HAVING count(*) > 1))"
    )


NULL_RULE = "expect_column_values_to_not_be_null"
RANGE_RULE = "expect_column_values_to_be_between"
UNIQUE_RULE = "expect_compound_columns_to_be_unique"
ORDER_RULE = "expect_table_columns_to_match_ordered_list"
TYPE_RULE = "expect_column_values_to_be_of_type"

SCORES = ["growth_metric", "market_metric", "demand_metric", "ease_metric", "market_score"]
MARKET = [
    "production_tonnes",
    "import_tonnes",
    "import_gap",
    "import_gap_normalized",
    "import_size_normalized",
]


def _formulas() -> str:
    p = plain_text
    w = {
        "size": "w1 * w21 * w32",
        "gap": "w1 * w21 * (1 - w32)",
        "cagr": "w1 * (1 - w21) * w31",
        "gdp": "w1 * (1 - w21) * (1 - w31)",
        "tariff": "(1 - w1) * w22",
        "dist": "(1 - w1) * (1 - w22)",
    }
    f = {k: p(f"round({e}, 4)") for k, e in w.items()}
    two = lambda e: p(f"round({e}, 2)")
    return f"""
    SELECT country_id, scenario,
      'ImportSize: ' || {p(w['size'])} || ' ImportGap: ' || {p(w['gap'])} || ' CAGR: '
        || {p(w['cagr'])} || ' GDP: ' || {p(w['gdp'])} || ' Tariff: ' || {f['tariff']}
        || ' Distance: ' || {f['dist']} AS weights_text,
      'Demand: ' || {p('w1')} || ' Ease: ' || {p('1 - w1')} AS demand_ease_text,
      {two('w1')} || ' * Popyt + ' || {two('1 - w1')} || ' * Bariery handlowe' AS score_text,
      {two('w21')} || ' * Handel + ' || {two('1 - w21')} || ' * Wzrost' AS demand_text,
      {two('w32')} || ' * Wielkość importu + ' || {two('1 - w32')} || ' * Luka importowa'
        AS trade_text,
      {two('w31')} || ' * CAGR importu + ' || {two('1 - w31')} || ' * Prognoza PKB' AS growth_text,
      '1 - (' || {two('w22')} || ' * Cło importowe + ' || {two('1 - w22')} || ' * Dystans)'
        AS barriers_text,
      {f['size']} || ' * Wielkość importu + ' || {f['gap']} || ' * Luka importowa + ' || {f['cagr']}
        || ' * CAGR importu + ' || {f['gdp']} || ' * Prognoza PKB + ' || {p('round(1 - w1, 4)')}
        || ' - ( ' || {f['tariff']} || ' * Cło importowe + ' || {f['dist']} || ' * Dystans)'
        AS whole_score_text
    FROM dim_partner, scenarios"""


def _merged(target: str, source: str, keys: list[str], values: list[str]) -> str:
    """Update matched rows, then insert the others."""
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    cols = [f"coalesce(t.{k}, s.{k}) AS {k}" for k in keys] + [
        f"CASE WHEN s.hit THEN s.{v} ELSE t.{v} END AS {v}" for v in values
    ]
    return (
        f"SELECT {', '.join(cols)} FROM ({target}) t "
        f"FULL JOIN (SELECT *, true AS hit FROM ({source})) s ON {on}"
    )


def _minmax(table: str, key: str, value: str, cut: str) -> str:
    return f"""
    SELECT {key}, {r(value, value)}, {r(
        '(cut - min(cut) OVER ()) / nullif(max(cut) OVER () - min(cut) OVER (), 0)', 'scaled')}
    FROM (SELECT {key}, {value}, {cut} AS cut FROM {table})"""


def _stable(table: str, keys: list[str], first: str, second: str) -> str:
    """Ids of two loads one after the other: the second's new keys follow the first's."""
    on = ", ".join(keys)
    return f"""
      WITH a AS (SELECT {on}, row_number() OVER (ORDER BY {on}) AS id
        FROM (SELECT DISTINCT {on} FROM {table} WHERE {first})),
      b AS (SELECT {on} FROM {table} WHERE {second} EXCEPT SELECT {on} FROM a)
      SELECT * FROM a UNION ALL
      SELECT {on}, row_number() OVER (ORDER BY {on}) + (SELECT max(id) FROM a) AS id FROM b"""


def _near_names(edits: int) -> str:
    """All pairs of misspelled names and aliases, the nearest kept where it is one code."""
    return f"""
      WITH c AS (SELECT c_custkey AS k, n_name AS n, CAST(c_custkey % 5 + 2 AS INTEGER) AS pos
        FROM customer JOIN nation ON c_nationkey = n_nationkey),
      names AS (SELECT DISTINCT CASE WHEN k % 7 = 0 THEN n
          WHEN k % 7 < 3 THEN left(n, pos) || substring(n, pos + 2)
          WHEN k % 7 = 3 THEN left(n, pos) || 'X' || substring(n, pos + 2)
          WHEN k % 7 < 6 THEN lower(left(n, pos) || CAST(k % 10 AS VARCHAR) || substring(n, pos + 1))
          ELSE 'q' || left(n, pos) || 'z' || substring(n, pos + 1) END AS country FROM c),
      aliases AS (SELECT lower(n_name) AS alias,
          'C' || CAST(n_nationkey - CASE WHEN n_nationkey = 12 THEN 11 ELSE 0 END AS VARCHAR) AS iso3 FROM nation
        UNION SELECT lower(n_name), 'D20' FROM nation WHERE n_nationkey = 20),
      pairs AS (SELECT country, iso3, levenshtein(lower(trim(country)), alias) AS d FROM names, aliases),
      best AS (SELECT country, min(d) AS d FROM pairs WHERE d <= {edits} GROUP BY country),
      found AS (SELECT country, d, CASE WHEN min(iso3) = max(iso3) THEN min(iso3) END AS iso3
        FROM pairs JOIN best USING (country, d) GROUP BY country, d)
      SELECT country, iso3, CAST(d AS INTEGER) AS distance FROM names LEFT JOIN found USING (country)"""


def _wide() -> str:
    """Repeated keys of documents and of line items, one row per check."""

    def one(position: int, table: str, keys: list[str], source: str) -> str:
        some = " OR ".join(f"{k} IS NOT NULL" for k in keys)
        again = (
            f"(SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM {source} WHERE {some} "
            f"GROUP BY {', '.join(keys)} HAVING count(*) > 1))"
        )
        return (
            f"SELECT {position} AS position, '{UNIQUE_RULE}' AS rule, 'N/A' AS \"column\", "
            f"CAST({again} AS BIGINT) AS unexpected_count, (SELECT count(*) FROM {source}) AS element_count, "
            f"{again} = 0 AS success, '{table}' AS \"table\""
        )

    dirty = (
        "(SELECT CASE WHEN l_partkey % 13 <> 0 THEN l_partkey END AS l_partkey, "
        "l_quantity - 5 AS l_quantity FROM lineitem)"
    )
    return " UNION ALL ".join(
        [
            one(0, "documents", ["doc_id", "text"], "documents"),
            one(1, "documents", ["source", "text"], "documents"),
            one(2, "documents", ["text"], "documents"),
            one(0, "lineitem", ["l_partkey", "l_quantity"], dirty),
        ]
    )


def oracle_sql() -> dict[str, str]:
    trade_values = [
        "product_weight_in_tonnes",
        "carcase_weight_in_tonnes",
        "value_in_thousand_euro",
        "last_month",
    ]
    history = (
        "SELECT name, year, sum({v}) AS {v} FROM market JOIN dim_partner USING (country_id) "
        "WHERE {v} IS NOT NULL AND year IN (SELECT DISTINCT year FROM market ORDER BY year DESC "
        "LIMIT 6) GROUP BY name, year"
    )
    weight_case = """CASE depth WHEN 3 THEN CASE WHEN parameter <> '' THEN leaf END
        WHEN 2 THEN CASE level2 WHEN 'Trade' THEN round(w1 * w21, 4)
          WHEN 'Growth' THEN round(w1 * (1 - w21), 4) ELSE leaf END
        WHEN 1 THEN CASE level1 WHEN 'Demand' THEN round(w1, 4) ELSE round(1 - w1, 4) END END"""
    levels = " UNION ALL ".join(
        f"SELECT country_id, scenario, {d} AS depth, {a} AS level1, {b} AS level2, "
        f"{c} AS parameter, max(w1) AS w1, max(w21) AS w21, max(weight) AS leaf, "
        "sum(weighted_value) AS wv FROM breakdown GROUP BY country_id, scenario"
        + "".join(f", {x}" for x in (a, b, c) if x != "NULL")
        for d, a, b, c in [
            (0, "NULL", "NULL", "NULL"),
            (1, "level1", "NULL", "NULL"),
            (2, "level1", "level2", "NULL"),
            (3, "level1", "level2", "parameter"),
        ]
    )
    out: dict[str, str] = {
        "dim_country": with_parts("SELECT * FROM dim_country", "dim_country"),
        "dim_partner": with_parts("SELECT * FROM dim_partner", "dim_partner"),
        "dim_ue_country": with_parts(
            "SELECT country_id, iso3, name FROM dim_country WHERE is_eu = 1", "dim_country"
        ),
        "dim_calendar": "SELECT unnest(generate_series(min(year(o_orderdate)), "
        "max(year(o_orderdate)))) AS year FROM orders",
        "surrogate_key": "SELECT row_number() OVER (ORDER BY p_name, p_partkey) "
        "AS part_id, p_partkey FROM part",
        "fact_production": with_parts("SELECT * FROM fact_production", "fact_production"),
        "fact_consumption": with_parts("SELECT * FROM fact_consumption", "fact_consumption"),
        "fact_import": with_parts("SELECT * FROM fact_import", "fact_import"),
        "market": _rounded(MARKET, ["country_id", "year", "consumption_tones"], "market", "market"),
        "minmax_by_year": f"""
          SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, {r(
            '''(o_totalprice - min(o_totalprice) OVER y)
               / nullif(max(o_totalprice) OVER y - min(o_totalprice) OVER y, 0)''',
            'o_totalprice_normalized')}
          FROM orders WINDOW y AS (PARTITION BY year(o_orderdate))""",
        "minmax_global": f"""
          SELECT c_custkey, {r(
            '''(c_acctbal - min(c_acctbal) OVER ())
               / nullif(max(c_acctbal) OVER () - min(c_acctbal) OVER (), 0)''', 'scaled')}
          FROM customer""",
        "winsor_low": _minmax(
            "customer", "c_custkey", "c_acctbal",
            "greatest(c_acctbal, (SELECT quantile_disc(c_acctbal, 0.06) FROM customer))",
        ),
        "winsor_high": _minmax(
            "orders", "o_orderkey", "o_totalprice",
            "least(o_totalprice, (SELECT quantile_disc(o_totalprice, 0.98) FROM orders))",
        ),
        "quantiles": "SELECT "
        + ", ".join(
            f"quantile_disc(l_extendedprice, {q}) AS {n}"
            for n, q in [
                ("q01", 0.01), ("q06", 0.06), ("q25", 0.25),
                ("q75", 0.75), ("q98", 0.98), ("q99", 0.99),
            ]
        )
        + " FROM lineitem",
        "gdp_growth": _rounded(
            ["gdp_forecast_growth_avg", "gdp_growth_forecast_normalized"],
            ["country_id", "n_years"], "forecast", "forecast",
        ),
        "cagr": _rounded(
            ["import_CAGR"],
            ["country_id", "first_year", "last_year", "max_year", "n_periods_non_null"],
            "cagr_raw", "cagr_raw",
        ),
        "growth": _rounded(
            ["gdp_forecast_growth_avg", "gdp_growth_forecast_normalized", "import_CAGR",
             "import_CAGR_normalized"],
            ["country_id", "n_years", "first_year", "last_year", "max_year",
             "n_periods_non_null"],
            "growth", "growth",
        ),
        "tariff_pairs": _rounded(
            ["tariff_average"], ["reporting_country_id", "partner_country_id", "year"],
            "tariff_pairs", "tariff_pairs",
        ),
        "tariff_avg": _rounded(
            ["tariff_avg", "tariff_avg_normalized"], ["country_id"], "tariff_level",
            "tariff_level",
        ),
        "distance": _rounded(
            ["dist", "dist_normalized"], ["country_id_o", "country_id_d"], "distance_level",
            "distance_level",
        ),
        "trade_barriers": _rounded(
            ["tariff_avg", "tariff_avg_normalized", "dist", "dist_normalized"], ["country_id"],
            "barriers", "barriers",
        ),
        "latest_year_fallback": _rounded(
            ["import_size", "import_gap", "size_n", "gap_n"], ["country_id"], "latest", "latest"
        ),
        "score": _rounded(
            SCORES, ["country_id", "name"], "scored", "scored", "WHERE scenario = 'default'"
        ),
        "score_legacy": with_parts(
            "SELECT country_id, name, "
            + r(
                "CASE WHEN coalesce(cagr_n, gdp_n, tariff_n, dist_n, gap_n, size_n) IS NOT NULL "
                "THEN coalesce(0.2 * cagr_n, 0) + coalesce(0.2 * gdp_n, 0) "
                "+ coalesce(0.05 * tariff_n, 0) + coalesce(0.05 * dist_n, 0) "
                "+ coalesce(0.25 * gap_n, 0) + coalesce(0.25 * size_n, 0) END",
                "score",
            )
            + " FROM indicators",
            "indicators",
        ),
        "score_top12": with_parts(
            f"SELECT country_id, name, {r('market_score', 'market_score')} FROM (SELECT *, "
            "rank() OVER (ORDER BY market_score DESC NULLS LAST) AS rnk FROM scored "
            "WHERE scenario = 'default') WHERE rnk <= 12 AND market_score IS NOT NULL",
            "scored",
        ),
        "score_scenarios": _rounded(
            SCORES, ["scenario", "country_id", "name"], "scored", "scored"
        ),
        "score_slider": with_parts(
            f"SELECT country_id, {r('i / 100.0', 'w_demand')}, "
            f"{r('demand_metric', 'demand_metric')}, {r('ease_metric', 'ease_metric')} "
            "FROM scored, range(101) AS s(i) WHERE scenario = 'default'",
            "scored",
        ),
        "indicator_breakdown": _rounded(
            ["value_normalized", "weight", "weighted_value"],
            ["country_id", "indicator", "indicator_order"], "breakdown", "breakdown",
            "WHERE scenario = 'default'",
        ),
        "indicator_text": with_parts(
            "SELECT country_id, indicator, value_text FROM breakdown WHERE scenario = 'default'",
            "breakdown",
        ),
        "indicator_shares": with_parts(
            f"SELECT country_id, indicator, indicator_order, "
            f"{r('weighted_value', 'weighted_value')}, "
            + r(
                "weighted_value / nullif(sum(weighted_value) OVER (PARTITION BY country_id), 0)",
                "share",
            )
            + " FROM breakdown WHERE scenario = 'default'",
            "breakdown",
        ),
        "partner_detail": _rounded(
            ["weight", "weighted_value"], ["name", "indicator"], "breakdown", "breakdown",
            "WHERE scenario = 'default' AND name = 'NATION_2'",
        ),
        "partner_card": with_parts(
            f"SELECT min(name) AS name, {r('max(market_score)', 'market_score')} FROM scored "
            "WHERE scenario = 'default' AND name = 'NATION_2'",
            "scored",
        ),
        "top12_by_scenario": with_parts(
            f"SELECT scenario, country_id, name, {r('market_score', 'market_score')} FROM (SELECT *, "
            "rank() OVER (PARTITION BY scenario ORDER BY market_score DESC) AS place FROM scored "
            "WHERE market_score IS NOT NULL) WHERE place <= 12",
            "scored",
        ),
        "ever_in_top12": with_parts(_EVER_IN_TOP, "indicators"),
        "top_lines_by_supplier": "SELECT l_suppkey, l_returnflag, l_orderkey, l_linenumber, l_extendedprice "
        "FROM (SELECT *, rank() OVER (PARTITION BY l_suppkey, l_returnflag ORDER BY l_extendedprice DESC) "
        "AS place FROM lineitem) WHERE place <= 3",
        "stable_country_ids": _stable("nation", ["n_name"], "n_nationkey % 3 <> 0", "n_nationkey % 4 <> 1"),
        "stable_part_ids": _stable("part", ["p_brand", "p_name"], "p_size <= 25", "p_size > 10"),
        "near_names": _near_names(1),
        "near_names_two_edits": _near_names(2),
        "merge_bucketed": f"""
          WITH l AS (SELECT l_orderkey, CASE WHEN l_partkey % 50 <> 0 THEN l_linenumber END AS l_linenumber,
              l_extendedprice FROM lineitem),
          a AS (SELECT * FROM l WHERE l_orderkey % 3 <> 0),
          b AS (SELECT * REPLACE (l_extendedprice + 1 AS l_extendedprice) FROM l WHERE l_orderkey % 4 <> 1),
          m AS (SELECT * FROM a UNION ALL SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM a
              WHERE a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber))
          SELECT l_orderkey, l_linenumber, {r('l_extendedprice', 'l_extendedprice')} FROM m""",
        "weight_rollup": with_parts(
            f"SELECT country_id, scenario, depth, level1, level2, parameter, "
            f"{r(weight_case, 'weight')}, {r('wv', 'weighted_value')} FROM ({levels})",
            "breakdown",
        ),
        "weight_texts": with_parts(_formulas(), "scenarios"),
        "weight_splits": with_parts(
            "SELECT country_id, scenario, "
            + ", ".join(
                r(e, n)
                for n, e in [
                    ("demand_split", "w1"), ("barriers_split", "round(1 - w1, 2)"),
                    ("trade_split", "w21"), ("growth_split", "round(1 - w21, 2)"),
                    ("import_size_split", "w32"), ("import_gap_split", "round(1 - w32, 2)"),
                    ("cagr_split", "w31"), ("gdp_split", "round(1 - w31, 2)"),
                    ("tariff_split", "w22"), ("distance_split", "round(1 - w22, 2)"),
                ]
            )
            + " FROM dim_partner, scenarios",
            "scenarios",
        ),
        "barrier_weights": with_parts(
            "SELECT country_id, scenario, indicator, "
            + r("CASE WHEN indicator_order >= 5 THEN weight END", "weight")
            + " FROM breakdown",
            "breakdown",
        ),
        "gap_year": with_parts(
            "SELECT country_id, CASE WHEN coalesce(c, p) IS NOT NULL "
            "THEN coalesce(c, 0) - coalesce(p, 0) END AS gap "
            "FROM (SELECT country_id, sum(consumption_tones) AS c, sum(production_tonnes) AS p "
            "FROM market WHERE year = 1999 GROUP BY country_id)",
            "market",
        ),
        "max_gap_year": with_parts(
            "SELECT CAST(max(coalesce(consumption_tones, 0) - coalesce(production_tonnes, 0)) "
            "AS DOUBLE) AS max_gap FROM market WHERE year = 1999 "
            "AND coalesce(consumption_tones, production_tonnes) IS NOT NULL",
            "market",
        ),
        "history_top6_years": with_parts(history.format(v="import_gap"), "market"),
        "history_import": with_parts(history.format(v="import_tonnes"), "market"),
        "diagnostic_table": with_parts(
            f"""SELECT i.name, {r('size_n', 'import_size_normalized')},
              {r('gap_n', 'import_gap_normalized')}, {r('i.import_gap', 'import_gap')},
              CAST(consumption_tones AS BIGINT) AS consumption_tones
            FROM indicators i LEFT JOIN (SELECT country_id, sum(consumption_tones)
              AS consumption_tones FROM market WHERE year = 2000 GROUP BY country_id) c
              USING (country_id)
            WHERE coalesce(size_n, gap_n, i.import_gap, consumption_tones) IS NOT NULL""",
            "indicators",
        ),
        "default_summary": with_parts(
            "SELECT year, CAST(sum(consumption_tones) AS BIGINT) AS consumption_tones, "
            + ", ".join(r(f"sum({c})", c) for c in MARKET)
            + " FROM market GROUP BY year",
            "market",
        ),
        "single_value": "SELECT o_custkey, CASE WHEN count(DISTINCT o_orderstatus) = 1 "
        "THEN max(o_orderstatus) END AS only_status, min(o_orderpriority) AS first_priority "
        "FROM orders GROUP BY o_custkey",
        "price_weeks": with_parts("SELECT * FROM prices", "prices"),
        "majority_month": """
          WITH p AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS begin_date,
              CAST(l_shipdate AS DATE) AS end_date
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
          spans AS (SELECT begin_date, end_date, unnest(generate_series(
              date_trunc('month', least(begin_date, end_date)),
              date_trunc('month', greatest(begin_date, end_date)), INTERVAL 1 MONTH)) AS m FROM p),
          shares AS (SELECT *, date_diff('day', greatest(CAST(m AS DATE), least(begin_date, end_date)),
              least(last_day(m), greatest(begin_date, end_date))) AS days FROM spans),
          best AS (SELECT *, row_number() OVER (PARTITION BY begin_date, end_date
              ORDER BY days DESC, m) AS rn FROM shares)
          SELECT begin_date, end_date, CAST(year(m) AS INTEGER) AS year,
            CAST(month(m) AS INTEGER) AS month_number FROM best WHERE rn = 1""",
        "production_silver": with_parts(
            f"SELECT heads, {r('kg_per_head', 'kg_per_head')}, member_state_code, "
            "member_state_name, month, tonnes, year, DATE '2001-12-31' AS created, "
            "DATE '2001-12-31' AS modified FROM monthly",
            "monthly",
        ),
        "trade_silver": with_parts(
            "SELECT flow, marketing_year, month_order, "
            "strftime(make_date(marketing_year, month_order, 1), '%B') AS month, "
            "DATE '2001-12-31' AS created, count(*) AS n_lines, "
            "sum(product_weight_in_tonnes) AS weight, "
            "CAST(sum(value_in_thousand_euro) AS DOUBLE) AS value "
            "FROM trade GROUP BY flow, marketing_year, month_order",
            "trade",
        ),
        "trade_union": with_parts(
            "SELECT flow, partner, count(*) AS n_lines, min(product_code) AS first_code "
            "FROM trade GROUP BY flow, partner",
            "trade",
        ),
        "export_import_last_month": with_parts("SELECT * FROM trade_rows", "trade_rows"),
        "trade_facts_incremental": with_parts("SELECT * FROM trade_rows", "trade_rows"),
        "upsert_trade_repeat": with_parts("SELECT * FROM trade_rows", "trade_rows"),
        "fact_prices": with_parts("SELECT * FROM price_rows", "price_rows"),
        "topn_else_other": with_parts("SELECT * FROM state_groups", "state_groups"),
        "production_groups": with_parts(
            f"SELECT heads, {r('kg_per_head', 'kg_per_head')}, tonnes, prod_key, country_group "
            "FROM production_rows",
            "production_rows",
        ),
        "bridge_member_date": with_parts("SELECT * FROM bridge", "bridge"),
        "dim_date": with_parts(
            "SELECT year_month, CAST(year(d) AS INTEGER) AS year, "
            "CAST(month(d) AS INTEGER) AS month_number, monthname(d) AS month_name, "
            "left(monthname(d), 3) AS month_short_name, "
            "CAST(replace(year_month, '-', '') AS INTEGER) AS year_month_int "
            "FROM (SELECT DISTINCT year_month, CAST(year_month || '-01' AS DATE) AS d FROM bridge)",
            "bridge",
        ),
        "insert_only_merge": f"""
          WITH t AS (SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders
              WHERE o_orderdate < TIMESTAMP '1999-07-01'),
          u AS (SELECT o_orderkey, CASE WHEN o_custkey % 10 <> 0 THEN o_custkey END AS o_custkey,
              o_orderdate, o_totalprice + 1 AS o_totalprice FROM orders
              WHERE o_orderdate >= TIMESTAMP '1998-07-01'),
          m AS (SELECT * FROM t UNION ALL SELECT * FROM u WHERE NOT EXISTS (SELECT 1 FROM t
              WHERE t.o_orderkey = u.o_orderkey AND t.o_custkey = u.o_custkey))
          SELECT o_orderkey, o_custkey, o_orderdate, {r('o_totalprice', 'o_totalprice')} FROM m""",
        "upsert_trade": with_parts(
            "SELECT * FROM ("
            + _merged(
                "SELECT * FROM early UNION ALL SELECT * REPLACE ('OLD ' || trade_key AS trade_key) "
                "FROM early WHERE flow = 'other'",
                "SELECT * FROM trade_rows",
                ["trade_key", "partner", "flow", "product_group"],
                trade_values,
            )
            + ")",
            "trade_rows",
        ).replace(
            "\nSELECT * FROM (",
            ", early AS (SELECT * REPLACE (-1.0::DOUBLE AS product_weight_in_tonnes, "
            "NULL::DOUBLE AS value_in_thousand_euro, 0 AS last_month) FROM trade_rows "
            "WHERE right(trade_key, 7) < '1998-01')\nSELECT * FROM (",
            1,
        ),
        "upsert_prices": with_parts(
            _merged(
                "SELECT * REPLACE (0.0::DOUBLE AS price, NULL::VARCHAR AS unit) FROM price_rows "
                "WHERE week_number <= 2",
                "SELECT * FROM price_rows",
                ["prices_key", "pig_class", "week_number"],
                ["price", "unit"],
            ),
            "price_rows",
        ),
        "upsert_production": with_parts(
            f"SELECT heads, {r('kg_per_head', 'kg_per_head')}, tonnes, prod_key, country_group "
            "FROM ("
            + _merged(
                "SELECT * REPLACE (0.0::DOUBLE AS tonnes, 'Unknown' AS country_group) "
                "FROM production_rows WHERE right(prod_key, 7) < '1999-01'",
                "SELECT * FROM production_rows",
                ["prod_key"],
                ["heads", "kg_per_head", "tonnes", "country_group"],
            )
            + ")",
            "production_rows",
        ),
        "upsert_one_per_key": """
          WITH t AS (SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '1998-07-01'),
          pick AS (SELECT l_orderkey, l_quantity, l_linenumber, row_number() OVER (
              PARTITION BY l_orderkey ORDER BY l_shipdate, l_quantity, l_linenumber) AS rn
            FROM lineitem)
          SELECT o_orderkey, coalesce(l_quantity, 0.0) AS quantity, l_linenumber AS line
          FROM t LEFT JOIN pick ON o_orderkey = l_orderkey AND rn = 1
          UNION ALL
          SELECT l_orderkey, l_quantity, l_linenumber FROM lineitem
          WHERE l_orderkey NOT IN (SELECT o_orderkey FROM t)""",
        "insert_missing": "SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS year_month FROM orders",
        "dq_not_null": _dq(
            [
                (NULL_RULE, "l_orderkey", _count("l_orderkey IS NULL")),
                (NULL_RULE, "l_partkey", _count("l_partkey IS NULL")),
            ]
        ),
        "dq_range": _dq(
            [
                (RANGE_RULE, "l_quantity", _count("l_quantity < 0")),
                (RANGE_RULE, "l_partkey", _count("l_partkey < 1 OR l_partkey > 500")),
            ]
        ),
        "dq_unique": _dq(
            [
                (UNIQUE_RULE, "N/A", _repeated("l_orderkey", "l_linenumber")),
                (UNIQUE_RULE, "N/A", _repeated("l_partkey", "l_quantity")),
            ]
        ),
        "dq_unique_wide": _wide(),
        "quantile_sketch_merged": "SELECT l_returnflag, count(*) AS n, CAST(share AS DOUBLE) AS share, true AS within "
        "FROM lineitem, (VALUES (0.06), (0.25), (0.75), (0.98)) AS s(share) GROUP BY l_returnflag, share",
        "extremes_from_sketches": "SELECT l_returnflag, "
        + r("avg((l_extendedprice - low) / (high - low))", "mean")
        + ", "
        + r("max((l_extendedprice - low) / (high - low))", "most")
        + " FROM lineitem, (SELECT min(l_extendedprice) AS low, max(l_extendedprice) AS high FROM lineitem) "
        "GROUP BY l_returnflag",
        "dq_schema": _dq(
            [
                (ORDER_RULE, "N/A", "0"),
                (ORDER_RULE, "N/A", _count("true")),
                (TYPE_RULE, "l_quantity", "0"),
                (TYPE_RULE, "l_partkey", _count("true")),
            ]
        ),
        "dq_summary": with_parts(
            f"""SELECT 'WARNING' AS severity,
              '⚠️ Validation failed for file lineitem.parquet: {NULL_RULE}(l_partkey): '
              || {_count('l_partkey IS NULL')} || '/' || {_count('true')}
              || ' failed; {RANGE_RULE}(l_quantity): ' || {_count('l_quantity < 0')} || '/'
              || {_count('true')} || ' failed; {UNIQUE_RULE}(N/A): '
              || CAST({_repeated('l_orderkey', 'l_linenumber')} AS BIGINT) || '/'
              || {_count('true')} || ' failed' AS message""",
            "dirty",
        ),
        "dq_log_twice": with_parts(
            f"""SELECT run_id, CAST(batch_id AS BIGINT) AS batch_id, severity, message
              FROM (VALUES ('first'), ('second')) AS r(run_id) CROSS JOIN (
              SELECT 0 AS batch_id, 'WARNING' AS severity,
              '⚠️ Validation failed for file lineitem.parquet: {NULL_RULE}(l_partkey): '
              || {_count('l_partkey IS NULL')} || '/' || {_count('true')}
              || ' failed; {RANGE_RULE}(l_quantity): ' || {_count('l_quantity < 0')} || '/'
              || {_count('true')} || ' failed; {UNIQUE_RULE}(N/A): '
              || CAST({_repeated('l_orderkey', 'l_linenumber')} AS BIGINT) || '/'
              || {_count('true')} || ' failed' AS message
              UNION ALL SELECT 1, 'SUCCESS', '✅ File orders.parquet passed validation successfully.')""",
            "dirty",
        ),
        "json_array_scan": "SELECT doc_id, md5(text) AS text_md5, lang, source, CAST(n_chars AS BIGINT) AS n_chars "
        "FROM documents",
        "latest_year_pruned": "SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS year, "
        "sum(l_quantity) AS quantity, count(*) AS n FROM lineitem, (SELECT max(year(l_shipdate)) AS latest "
        "FROM lineitem WHERE year(l_shipdate) < 1998 AND l_extendedprice IS NOT NULL) "
        "WHERE year(l_shipdate) IN (latest, latest - 1) GROUP BY l_suppkey, year(l_shipdate)",
        "json_extract": "SELECT event_id, CAST(props->>'$.k' AS INTEGER) AS k FROM events",
        "nested_json_scan": "SELECT n_name AS country, c_mktsegment AS iso3, "
        "CAST(c_custkey AS INTEGER) AS year, "
        "CASE WHEN c_acctbal > 0 THEN CAST(trunc(c_acctbal) AS BIGINT) END AS population "
        "FROM customer JOIN nation ON c_nationkey = n_nationkey",
        "csv_scan": "SELECT s_name AS entity, n_name AS code, CAST(s_suppkey AS INTEGER) AS year, "
        "s_acctbal AS production_tonnes, s_name || '_' || s_suppkey AS key "
        "FROM supplier JOIN nation ON s_nationkey = n_nationkey",
        "payload_unwrap": "SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k FROM events "
        "WHERE event_type <> 'error' UNION ALL "
        "SELECT event_id, user_id FROM events WHERE event_type <> 'error'",
        "latest_snapshot": "SELECT event_id, user_id, CAST(ts AS DATE) AS ingestion_date "
        "FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)",
        "alias_to_code": "SELECT c_custkey, CASE WHEN c_nationkey <> 7 THEN 'C' || c_nationkey END "
        "AS iso3 FROM customer",
        "unknown_names": "SELECT 'country' AS role, n_name AS name, count(*) AS n_rows "
        "FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey >= 4 "
        "GROUP BY n_name",
        "sentinel_to_null": with_parts("SELECT * FROM raw_distance", "raw_distance"),
        "text_to_number": "SELECT p_partkey, CASE WHEN p_size % 9 <> 0 THEN p_retailprice END "
        "AS price, CASE WHEN p_size % 9 <> 0 THEN CAST(trunc(p_retailprice) AS INTEGER) END "
        "AS whole_price FROM part",
        "entity_year_key": "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' "
        "THEN o_orderstatus || '_' ELSE '' END || year(o_orderdate) AS key FROM orders",
        "state_month_keys": """
          SELECT o_orderkey, s || '-' || strftime(o_orderdate, '%Y-%m') AS key, s AS state,
            strftime(o_orderdate, '%Y-%m') AS year_month
          FROM (SELECT *, CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_mktsegment ELSE '' END AS s
            FROM orders JOIN customer ON o_custkey = c_custkey)""",
    }
    return out
