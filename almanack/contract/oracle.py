"""The SQL of every registered query, over the given tables alone."""

from __future__ import annotations

from almanack import schemas as S
from almanack.contract import driver_tables as T

START = f"TIMESTAMP '{T.PROJECT_START}-01'"
SPLIT = "TIMESTAMP '2000-01-01'"


def _sum(column: str) -> str:
    """The exact sum (no measure has more than six decimals) as a double."""
    return f"CAST(SUM(CAST({column} AS DECIMAL(28,6))) AS DOUBLE)"


def _avg(column: str) -> str:
    return f"(CAST(SUM(CAST({column} AS DECIMAL(28,6))) AS DOUBLE) / COUNT({column}))"


def _round(expression: str, digits: int) -> str:
    """ROUND, half away from zero on the decimal text of the double (DuckDB's own works on
    its binary value, so that it takes 2.675 for less than it reads)."""
    text = f"CAST(CAST({expression} AS DOUBLE) AS VARCHAR)"
    return f"CAST(ROUND(CAST({text} AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def _units(column: str) -> str:
    """Exact sum in ten-thousandths."""
    return f"CAST(SUM(CAST({column} AS DECIMAL(18,4))) * 10000 AS BIGINT)"


def _change(first: str, latest: str) -> str:
    return _round(f"(100.0 * ({latest} - {first}) / NULLIF({first}, 0))", 1)


def _entities(level: str) -> str:
    if level == "nation":
        return (
            "SELECT n_nationkey, n_name AS entity, n_regionkey, "
            "'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS entity_code FROM nation"
        )
    return (
        "SELECT n_nationkey, r_name AS entity, n_regionkey, "
        "'R' || CAST(r_regionkey AS VARCHAR) AS entity_code "
        "FROM nation JOIN region ON n_regionkey = r_regionkey"
    )


def _series_frame(name: str, amount: str, measure: str, share: str) -> str:
    return f"""
{name}_parts AS (
  SELECT entity, entity_code, date,
         CASE WHEN p_type = 'PROMO' THEN 'Net imports' ELSE p_type END AS series,
         SUM({amount}) AS amount
  FROM lines JOIN entities ON nationkey = n_nationkey GROUP BY ALL),
{name}_total AS (
  SELECT entity, entity_code, date, SUM(amount) AS amount FROM {name}_parts
  WHERE series <> 'Net imports' GROUP BY ALL),
{name} AS (
  SELECT r.entity, r.entity_code, false AS is_aggregate_entity, r.date, r.series,
         r.is_aggregate_series, CAST(r.amount AS DOUBLE) AS {measure},
         {_round("COALESCE(100.0 * CAST(r.amount AS DOUBLE) / NULLIF(CAST(t.amount AS DOUBLE), 0), 0.0)", 6)}
           AS {share}
  FROM (SELECT *, false AS is_aggregate_series FROM {name}_parts
        UNION ALL
        SELECT entity, entity_code, date, 'Total generation', amount, true FROM {name}_total) r
  LEFT JOIN {name}_total t ON r.entity_code = t.entity_code AND r.date = t.date),"""


def _prelude(level: str = "nation") -> str:
    """The five datasets and the nine model tables as common table expressions."""
    categories = ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in T.SERIES_CLASSIFICATION)
    core = " UNION ".join(f"SELECT date FROM {name}" for name in S.CORE_DATASETS)
    everywhere = " UNION ".join(f"SELECT entity_code, entity FROM {name}" for name in S.DATASETS)
    return f"""
WITH entities AS ({_entities(level)}),
lines AS (
  SELECT c_nationkey AS nationkey, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS date,
         p_type, l_returnflag = 'R' AS returned,
         SUM(CAST(l_quantity AS DECIMAL(18,2))) AS q,
         SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(18,2))) AS e
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
{_series_frame("generation", "CASE WHEN p_type = 'PROMO' AND returned THEN -q ELSE q END",
               "generation_twh", "share_of_generation_pct")}
{_series_frame("emissions", "CASE WHEN p_type = 'PROMO' THEN 0 ELSE e END",
               "emissions_mtco2", "share_of_emissions_pct")}
demand AS (
  SELECT entity, entity_code, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS date,
         CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS demand_twh
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN entities ON c_nationkey = n_nationkey
  GROUP BY ALL),
carbon_intensity AS (
  SELECT entity, entity_code, date,
         {_round("(CAST(SUM(e) AS DOUBLE) / NULLIF(CAST(SUM(q) AS DOUBLE), 0))", 6)}
           AS emissions_intensity_gco2_per_kwh
  FROM lines JOIN entities ON nationkey = n_nationkey WHERE p_type <> 'PROMO' GROUP BY ALL),
supply AS (
  SELECT entity, entity_code, CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS date,
         CASE p_type WHEN 'SMALL' THEN 'Solar' ELSE 'Wind' END AS series,
         CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS gw, COUNT(*) AS n
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN entities ON s_nationkey = n_nationkey WHERE p_type IN ('SMALL', 'LARGE') GROUP BY ALL),
capacity AS (
  SELECT entity, entity_code, false AS is_aggregate_entity, date, series,
         series = 'Wind' AS is_aggregate_series, gw AS capacity_gw,
         {_round("(1000.0 * gw / CAST(n AS DOUBLE))", 6)} AS capacity_w_per_capita
  FROM supply),
dim_date AS (
  SELECT date, CAST(year(date) AS BIGINT) AS year, CAST(quarter(date) AS BIGINT) AS quarter,
         CAST(month(date) AS BIGINT) AS month_number, monthname(date) AS month_name,
         strftime(date, '%Y-%m') AS year_month,
         COUNT(*) OVER (PARTITION BY year(date)) = 12 AS is_complete_year
  FROM ({core})),
dim_country AS (
  SELECT entity_code, entity AS country_name,
         entity_code IN (SELECT entity_code FROM entities JOIN region ON n_regionkey = r_regionkey
                         WHERE r_name = 'EUROPE') AS eu_member_flag
  FROM ({everywhere})),
categories(series_name, technology_group, energy_category) AS (VALUES {categories}),
dim_energy_series AS (
  SELECT CAST('0x' || substr(sha256(series), 1, 15) AS BIGINT) AS series_key,
         series AS series_name, COALESCE(technology_group, 'Unclassified') AS technology_group,
         COALESCE(energy_category, 'Unclassified') AS energy_category, is_aggregate_series
  FROM (SELECT series, is_aggregate_series FROM generation
        UNION SELECT series, is_aggregate_series FROM emissions)
  LEFT JOIN categories ON series = series_name),
dim_capacity_series AS (
  SELECT CAST('0x' || substr(sha256('capacity::' || series), 1, 15) AS BIGINT)
           AS capacity_series_key, series AS series_name, is_aggregate_series
  FROM (SELECT DISTINCT series, is_aggregate_series FROM capacity)),
fact_generation AS (
  SELECT date, entity_code, series_key, generation_twh, share_of_generation_pct
  FROM generation LEFT JOIN dim_energy_series ON series = series_name),
fact_emissions AS (
  SELECT date, entity_code, series_key, emissions_mtco2, share_of_emissions_pct
  FROM emissions LEFT JOIN dim_energy_series ON series = series_name),
fact_demand AS (SELECT date, entity_code, demand_twh FROM demand),
fact_carbon_intensity AS (
  SELECT date, entity_code, emissions_intensity_gco2_per_kwh FROM carbon_intensity),
fact_capacity AS (
  SELECT date, entity_code, capacity_series_key, capacity_gw, capacity_w_per_capita
  FROM capacity LEFT JOIN dim_capacity_series ON series = series_name),
"""


_BEFORE = f"year < {T.AS_OF_YEAR}"
_YEAR = "COUNT(DISTINCT month_number) = 12"

# Yearly tables, the common period and the four marts.
_MARTS = f"""
gen AS (
  SELECT f.*, d.year, d.month_number, s.series_name, s.energy_category, s.is_aggregate_series,
         NOT s.is_aggregate_series AND s.series_name <> 'Net imports' AS is_component
  FROM fact_generation f JOIN dim_date d ON f.date = d.date
  JOIN dim_energy_series s ON f.series_key = s.series_key),
annual_generation AS (
  SELECT entity_code, year, {_sum("generation_twh")} AS generation_twh
  FROM gen WHERE is_component AND {_BEFORE} GROUP BY entity_code, year HAVING {_YEAR}),
annual_demand AS (
  SELECT entity_code, year, {_sum("demand_twh")} AS demand_twh
  FROM fact_demand f JOIN dim_date d ON f.date = d.date WHERE {_BEFORE}
  GROUP BY entity_code, year HAVING {_YEAR}),
annual_domestic AS (
  SELECT entity_code, year,
         {_sum("CASE WHEN is_component THEN generation_twh ELSE 0 END")} AS domestic_generation_twh,
         {_sum("CASE WHEN series_name = 'Net imports' THEN generation_twh ELSE 0 END")}
           AS net_imports_twh
  FROM gen WHERE {_BEFORE} GROUP BY entity_code, year HAVING {_YEAR}),
annual_balance AS (
  SELECT entity_code, year, domestic_generation_twh, net_imports_twh, demand_twh
  FROM annual_domestic JOIN annual_demand USING (entity_code, year)),
sources AS (
  SELECT source_name, year, COUNT(DISTINCT month_number) AS months
  FROM (SELECT 'generation' AS source_name, date FROM fact_generation
        UNION ALL SELECT 'demand', date FROM fact_demand
        UNION ALL SELECT 'emissions', date FROM fact_emissions
        UNION ALL SELECT 'carbon_intensity', date FROM fact_carbon_intensity
        UNION ALL SELECT lower(series_name) || '_capacity', date
                  FROM fact_capacity JOIN dim_capacity_series USING (capacity_series_key)
                  WHERE series_name IN ('Solar', 'Wind')) x
  JOIN dim_date USING (date) GROUP BY source_name, year),
period AS (
  SELECT CAST({T.BASELINE_YEAR} AS BIGINT) AS start_year, MAX(year) AS end_year
  FROM (SELECT year FROM sources
        WHERE year >= {T.BASELINE_YEAR} AND {_BEFORE} AND months = 12
        GROUP BY year HAVING COUNT(*) = 6)
  HAVING MAX(year) IS NOT NULL),
country_period AS (
  SELECT entity_code, start_year, end_year FROM annual_balance, period
  WHERE year = start_year OR year = end_year
  GROUP BY ALL HAVING COUNT(DISTINCT year) = 2),
mart_generation_demand_summary AS (
  SELECT country_name, entity_code, start_year, end_year,
         {_round("a.domestic_generation_twh", 2)} AS first_generation_twh,
         {_round("b.domestic_generation_twh", 2)} AS latest_generation_twh,
         {_change("a.domestic_generation_twh", "b.domestic_generation_twh")}
           AS generation_change_pct,
         {_round("a.demand_twh", 2)} AS first_demand_twh,
         {_round("b.demand_twh", 2)} AS latest_demand_twh,
         {_change("a.demand_twh", "b.demand_twh")} AS demand_change_pct,
         {_round("a.net_imports_twh", 2)} AS first_net_imports_twh,
         {_round("b.net_imports_twh", 2)} AS latest_net_imports_twh
  FROM country_period JOIN dim_country USING (entity_code)
  JOIN annual_balance a USING (entity_code) JOIN annual_balance b USING (entity_code)
  WHERE a.year = start_year AND b.year = end_year),
monthly_mix AS (
  SELECT entity_code, date, year, month_number, energy_category,
         {_sum("generation_twh")} AS generation_twh
  FROM gen WHERE is_component GROUP BY ALL),
annual_mix AS (
  SELECT entity_code, year, energy_category, COUNT(DISTINCT month_number) AS months_available,
         {_sum("generation_twh")} AS generation_twh
  FROM monthly_mix WHERE {_BEFORE} GROUP BY entity_code, year, energy_category),
complete_country_years AS (
  SELECT entity_code, year FROM fact_generation JOIN dim_date USING (date)
  WHERE {_BEFORE} GROUP BY entity_code, year HAVING {_YEAR}),
annual_total AS (
  SELECT entity_code, year, {_sum("generation_twh")} AS total_generation_twh
  FROM annual_mix JOIN complete_country_years USING (entity_code, year)
  GROUP BY entity_code, year),
annual_shares AS (
  SELECT entity_code, year, energy_category, generation_twh,
         100.0 * generation_twh / NULLIF(total_generation_twh, 0) AS generation_share_pct
  FROM annual_mix JOIN annual_total USING (entity_code, year)),
eligible_countries AS (
  SELECT entity_code FROM annual_total, period WHERE year IN (start_year, end_year)
  GROUP BY entity_code HAVING COUNT(DISTINCT year) = 2),
mix_pivot AS (
  SELECT entity_code, start_year, end_year, {", ".join(
    f"COALESCE(MAX(generation_share_pct) FILTER (year = {when}_year "
    f"AND energy_category = '{c}'), 0.0) AS {c.lower()}_{when}_pct"
    for c in ("Renewable", "Fossil", "Clean") for when in ("start", "end"))}
  FROM annual_shares, period WHERE year IN (start_year, end_year)
    AND entity_code IN (SELECT entity_code FROM eligible_countries)
  GROUP BY entity_code, start_year, end_year),
mart_energy_mix_transition_summary AS (
  SELECT country_name, entity_code, start_year, end_year, {", ".join(
    f"{_round(f'{c}_start_pct', 1)} AS {c}_start_pct, {_round(f'{c}_end_pct', 1)} AS {c}_end_pct, "
    f"{_round(f'({c}_end_pct - {c}_start_pct)', 1)} AS {c}_change_pp"
    for c in ("renewable", "fossil", "clean"))}
  FROM mix_pivot JOIN dim_country USING (entity_code)),
annual_emissions AS (
  SELECT entity_code, year, start_year, end_year, {_sum("emissions_mtco2")} AS emissions_mtco2
  FROM fact_emissions JOIN dim_date USING (date) JOIN dim_energy_series USING (series_key), period
  WHERE series_name = 'Total generation' AND year IN (start_year, end_year)
  GROUP BY ALL HAVING {_YEAR}),
annual_intensity AS (
  SELECT entity_code, year, start_year, end_year,
         {_avg("emissions_intensity_gco2_per_kwh")} AS avg_carbon_intensity_gco2_per_kwh
  FROM fact_carbon_intensity JOIN dim_date USING (date), period
  WHERE year IN (start_year, end_year) GROUP BY entity_code, year, start_year, end_year
  HAVING {_YEAR}),
emissions_pivot AS (
  SELECT c.entity_code, c.country_name,
         MAX(emissions_mtco2) FILTER (e.year = e.start_year) AS emissions_start_mtco2,
         MAX(emissions_mtco2) FILTER (e.year = e.end_year) AS emissions_end_mtco2,
         MAX(avg_carbon_intensity_gco2_per_kwh) FILTER (i.year = i.start_year)
           AS carbon_intensity_start,
         MAX(avg_carbon_intensity_gco2_per_kwh) FILTER (i.year = i.end_year)
           AS carbon_intensity_end
  FROM dim_country c LEFT JOIN annual_emissions e ON c.entity_code = e.entity_code
  LEFT JOIN annual_intensity i ON c.entity_code = i.entity_code
  GROUP BY c.entity_code, c.country_name),
mart_emissions_carbon_intensity AS (
  SELECT start_year, end_year, country_name,
         {_round("emissions_start_mtco2", 2)} AS emissions_start_mtco2,
         {_round("emissions_end_mtco2", 2)} AS emissions_end_mtco2,
         {_change("emissions_pivot.emissions_start_mtco2", "emissions_pivot.emissions_end_mtco2")}
           AS emissions_change_pct,
         {_round("emissions_pivot.carbon_intensity_start", 1)} AS carbon_intensity_start,
         {_round("emissions_pivot.carbon_intensity_end", 1)} AS carbon_intensity_end,
         {_round("(emissions_pivot.carbon_intensity_end - emissions_pivot.carbon_intensity_start)", 1)}
           AS carbon_intensity_change_gco2_per_kwh
  FROM emissions_pivot, period
  WHERE emissions_pivot.emissions_start_mtco2 IS NOT NULL
    AND emissions_pivot.emissions_end_mtco2 IS NOT NULL
    AND emissions_pivot.carbon_intensity_start IS NOT NULL
    AND emissions_pivot.carbon_intensity_end IS NOT NULL),
annual_capacity AS (
  SELECT entity_code, year, series_name, start_year, end_year,
         {_avg("capacity_gw")} AS avg_capacity_gw
  FROM fact_capacity JOIN dim_date USING (date)
  JOIN dim_capacity_series USING (capacity_series_key), period
  WHERE series_name IN ('Solar', 'Wind') AND year IN (start_year, end_year)
  GROUP BY entity_code, year, series_name, start_year, end_year HAVING {_YEAR}),
capacity_pivot AS (
  SELECT entity_code, country_name, {", ".join(
    f"MAX(avg_capacity_gw) FILTER (year = {when}_year AND series_name = '{s}') "
    f"AS {s.lower()}_{when}_gw" for s in ("Solar", "Wind") for when in ("start", "end"))}
  FROM dim_country JOIN annual_capacity USING (entity_code) GROUP BY entity_code, country_name),
capacity_sums AS (
  SELECT *, solar_start_gw + wind_start_gw AS both_start, solar_end_gw + wind_end_gw AS both_end
  FROM capacity_pivot WHERE solar_start_gw IS NOT NULL AND solar_end_gw IS NOT NULL
    AND wind_start_gw IS NOT NULL AND wind_end_gw IS NOT NULL),
mart_installed_solar_wind_capacity AS (
  SELECT start_year, end_year, country_name,
         {_round("x.solar_start_gw", 2)} AS solar_start_gw,
         {_round("x.solar_end_gw", 2)} AS solar_end_gw,
         {_change("x.solar_start_gw", "x.solar_end_gw")} AS solar_change_pct,
         {_round("x.wind_start_gw", 2)} AS wind_start_gw,
         {_round("x.wind_end_gw", 2)} AS wind_end_gw,
         {_change("x.wind_start_gw", "x.wind_end_gw")} AS wind_change_pct,
         {_round("x.both_start", 2)} AS solar_wind_start_gw,
         {_round("x.both_end", 2)} AS solar_wind_end_gw,
         {_change("x.both_start", "x.both_end")} AS solar_wind_change_pct
  FROM capacity_sums x, period)
"""


def _on_datasets(select: str, level: str = "nation") -> str:
    # The trailing comma of the prelude needs one more table expression.
    return f"{_prelude(level)} one AS (SELECT 1) {select}"


def _on_marts(select: str, level: str = "nation") -> str:
    return f"{_prelude(level)} {_MARTS} {select}"


def _per_dataset(template: str, names=S.DATASETS) -> str:
    return " UNION ALL ".join(template.format(d=name) for name in names)


_NATION_CODES = f"SELECT entity_code, n_regionkey FROM ({_entities('nation')})"
_FILES = """
SELECT 'ship/' || strftime(l_shipdate, '%Y-%m') || '.json' AS path,
       MAX(CAST(l_shipdate AS TIMESTAMP)) AS mtime, COUNT(*) AS length
FROM lineitem GROUP BY 1"""
_KEYS = "SELECT COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber"

# generation up to the split, then two loads that overlap it
_LOADS = f"""
SELECT *, 0 AS source_rank, CAST(NULL AS VARCHAR) AS path, CAST(NULL AS BIGINT) AS pos
FROM generation WHERE date < {SPLIT}
UNION ALL
SELECT * REPLACE (generation_twh + 1 AS generation_twh), 1, 'load/a.json', month(date)
FROM generation WHERE date >= TIMESTAMP '1999-07-01'
UNION ALL
SELECT * REPLACE (generation_twh * 2 AS generation_twh), 1, 'load/b.json', month(date)
FROM generation WHERE date >= TIMESTAMP '2000-06-01'"""
_GENERATION_COLUMNS = ", ".join(S.SILVER_SCHEMAS["generation"].fieldNames())
_MERGED = _on_datasets(
    f"""SELECT {_GENERATION_COLUMNS} FROM ({_LOADS})
    QUALIFY row_number() OVER (PARTITION BY entity_code, date, series
      ORDER BY source_rank DESC, path DESC) = 1"""
)
_TWO_LOADS = _on_datasets(
    f"""SELECT * REPLACE (CASE WHEN date >= TIMESTAMP '1999-07-01' THEN generation_twh + 1
    ELSE generation_twh END AS generation_twh) FROM generation WHERE date >= {START}"""
)


def _metric(table: str, check: str, column: str | None, value: str) -> str:
    """One metric row; SELECT list over whatever FROM follows."""
    name = "CAST(NULL AS VARCHAR)" if column is None else f"'{column}'"
    passed = "true" if check == "row_count" else f"COALESCE({value}, 0) = 0"
    return (
        f"'{table}' AS table_name, '{check}' AS check_name, {name} AS column_name, "
        f"CAST(COALESCE({value}, 0) AS BIGINT) AS value, {passed} AS passed"
    )


def _nulls(column: str) -> str:
    return f"COUNT(*) FILTER ({column} IS NULL)"


def _silver_report() -> str:
    parts = []
    for name in S.DATASETS:
        key = ", ".join(S.BUSINESS_KEYS[name])
        groups = f"(SELECT COUNT(*) AS n FROM {name} GROUP BY {key})"
        scope = "n_regionkey <= 1" if name == "capacity" else "true"
        parts.append(f"SELECT {_metric(name, 'row_count', None, 'COUNT(*)')} FROM {name}")
        parts.append(
            f"SELECT {_metric(name, 'duplicate_keys', None, 'SUM(n - 1)')} FROM {groups}"
        )
        for column in (*S.BUSINESS_KEYS[name], *S.MEASURES[name]):
            parts.append(
                f"SELECT {_metric(name, 'null_count', column, _nulls(column))} FROM {name}"
            )
        parts.append(
            f"SELECT {_metric(name, 'unexpected_countries', None, 'COUNT(DISTINCT entity_code)')} "
            f"FROM {name} WHERE entity_code NOT IN "
            f"(SELECT entity_code FROM entities WHERE {scope})"
        )
    return " UNION ALL ".join(parts)


def _repeated(table: str, key) -> str:
    return f"(SELECT COUNT(*) AS n FROM {table} GROUP BY {', '.join(key)} HAVING COUNT(*) > 1)"


def _dimension_report() -> str:
    parts = []
    for table, key in S.DIMENSION_KEYS.items():
        parts.append(
            f"SELECT {_metric(table, 'duplicate_keys', None, 'SUM(n)')} FROM {_repeated(table, key)}"
        )
        parts += [f"SELECT {_metric(table, 'null_key', c, _nulls(c))} FROM {table}" for c in key]
    return " UNION ALL ".join(parts)


def _fact_report() -> str:
    parts = []
    for table, grain in S.FACT_GRAINS.items():
        parts.append(
            f"SELECT {_metric(table, 'duplicate_grain', None, 'SUM(n)')} "
            f"FROM {_repeated(table, grain)}"
        )
        parts += [f"SELECT {_metric(table, 'null_grain', c, _nulls(c))} FROM {table}" for c in grain]
        parts += [
            f"SELECT {_metric(table, 'null_measure', c, _nulls(c))} FROM {table}"
            for c in S.FACT_MEASURES[table]
        ]
    return " UNION ALL ".join(parts)


def _foreign_key_report() -> str:
    names = {
        "date": "orphan_dates",
        "entity_code": "orphan_countries",
        "series_key": "orphan_series",
        "capacity_series_key": "orphan_capacity_series",
    }
    parts = []
    for table, grain in S.FACT_GRAINS.items():
        for key, name in names.items():
            if key in grain:
                orphans = f"FROM {table} f ANTI JOIN {S.FOREIGN_KEYS[key]} d ON f.{key} IS NOT DISTINCT FROM d.{key}"
                parts.append(f"SELECT {_metric(table, name, key, 'COUNT(*)')} {orphans}")
            else:
                parts.append(f"SELECT {_metric(table, name, key, '0')}")
    return " UNION ALL ".join(parts)


def _persisted() -> str:
    parts = []
    for table in S.GOLD_TABLES:
        key = S.DIMENSION_KEYS.get(table) or S.FACT_GRAINS[table]
        columns = [*key, *S.FACT_MEASURES.get(table, ())]
        joins, broken = "", "false"
        if table in S.FACT_GRAINS:
            joins = " ".join(
                f"LEFT JOIN {S.FOREIGN_KEYS[c]} d{i} ON f.{c} = d{i}.{c}" for i, c in enumerate(key)
            )
            broken = " OR ".join(f"d{i}.{c} IS NULL" for i, c in enumerate(key))
        empty = " OR ".join(f"f.{c} IS NULL" for c in columns)
        parts.append(
            f"SELECT '{table}' AS table_name, COUNT(*) AS total_records, "
            f"COUNT(*) FILTER ({empty}) AS null_required_fields, "
            f"COUNT(*) FILTER ({broken}) AS invalid_foreign_keys, "
            f"(SELECT COUNT(*) FROM {_repeated(table, key)}) AS duplicate_key_groups "
            f"FROM {table} f {joins}"
        )
    return " UNION ALL ".join(parts)


def _gold_counts(condition: str = "true") -> str:
    """Rows per table of the publishable model, built from the rows that meet
    the condition; capacity is limited to the months of the core datasets."""
    within = f"date IN (SELECT date FROM dim_date) AND {condition}"
    dated = "COUNT(*) AS row_count, MIN(date) AS first_date, MAX(date) AS last_date"
    plain = "COUNT(*), NULL, NULL, NULL"
    parts = [
        f"SELECT 'dim_date' AS table_name, {dated}, NULL::DOUBLE AS total FROM dim_date WHERE {condition}",
        f"SELECT 'dim_country', {plain} FROM ({' UNION '.join(f'SELECT entity_code, entity FROM {d} WHERE {within}' for d in S.DATASETS)})",
        f"SELECT 'dim_energy_series', {plain} FROM ({' UNION '.join(f'SELECT series, is_aggregate_series FROM {d} WHERE {within}' for d in S.ENERGY_SERIES_DATASETS)})",
        f"SELECT 'dim_capacity_series', {plain} FROM (SELECT DISTINCT series, is_aggregate_series FROM capacity WHERE {within})",
    ]
    parts += [
        f"SELECT '{t}', {dated}, {_round(_sum(S.FACT_MEASURES[t][0]), 2)} FROM {t} WHERE {within}"
        for t in S.FACT_GRAINS
    ]
    return " UNION ALL ".join(parts)


def _column_profile() -> str:
    parts = []
    for field in S.SILVER_SCHEMAS["generation"]:
        c, kind = field.name, field.dataType.simpleString()
        parts.append(
            f"SELECT 'generation' AS dataset, '{c}' AS \"column\", '{kind}' AS dtype, "
            f"CAST(SUM(n) AS BIGINT) AS row_count, "
            f"CAST(COALESCE(SUM(n) FILTER (v IS NULL), 0) AS BIGINT) AS null_count, "
            f"{_round('(100.0 * COALESCE(SUM(n) FILTER (v IS NULL), 0) / SUM(n))', 2)} AS null_pct, "
            f"COUNT(v) AS unique_values, "
            f"COALESCE(string_agg(v, ', ' ORDER BY seen) FILTER (v IS NOT NULL AND r <= 3), '') "
            f"AS sample_values "
            f"FROM (SELECT *, row_number() OVER (ORDER BY v IS NULL, seen) AS r FROM "
            f"(SELECT CAST({c} AS VARCHAR) AS v, COUNT(*) AS n, MIN(rn) AS seen FROM numbered GROUP BY 1))"
        )
    rows = " UNION ALL ".join(parts)
    return (
        f"{_prelude()} numbered AS (SELECT *, row_number() OVER "
        f"(ORDER BY date, entity_code, series) AS rn FROM generation) {rows}"
    )


def _describe() -> str:
    parts = []
    for name, measures in S.MEASURES.items():
        for m in measures:
            parts.append(
                f"SELECT '{name}' AS dataset, '{m}' AS measure, COUNT({m}) AS count, "
                f"{_round(f'({_avg(m)})', 6)} AS mean, {_round(f'stddev_samp({m})', 4)} AS std, "
                f"MIN({m}) AS min, "
                + ", ".join(
                    f"{_round(f'quantile_cont({m}, {p})', 6)} AS {q}"
                    for q, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))
                )
                + f", MAX({m}) AS max FROM {name}"
            )
    return " UNION ALL ".join(parts)


_COMPONENTS = "NOT is_aggregate_series AND series <> 'Net imports'"


def _quartiles(source: str, by: str, value: str) -> str:
    return (
        f"SELECT {by}, q1, median, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_bound, "
        f"q3 + 1.5 * (q3 - q1) AS upper_bound FROM (SELECT {by}, "
        f"quantile_cont({value}, 0.25) AS q1, quantile_cont({value}, 0.5) AS median, "
        f"quantile_cont({value}, 0.75) AS q3 FROM {source} GROUP BY {by})"
    )


def _iqr(source: str, by: str, value: str) -> str:
    outside = f"{value} < lower_bound OR {value} > upper_bound"
    bounds = ", ".join(
        f"{_round(f'ANY_VALUE({c})', 2)} AS {c}"
        for c in ("q1", "q3", "iqr", "lower_bound", "upper_bound")
    )
    return (
        f"SELECT {by}, {bounds}, COUNT(*) FILTER ({outside}) AS outlier_count, "
        f"{_round(f'(100.0 * COUNT(*) FILTER ({outside}) / CAST(COUNT(*) AS DOUBLE))', 2)} AS outlier_pct "
        f"FROM {source} JOIN ({_quartiles(source, by, value)}) USING ({by}) GROUP BY {by}"
    )


def _boxplot(source: str, by: str, value: str) -> str:
    inside = f"{value} BETWEEN lower_bound AND upper_bound"
    return (
        f"SELECT {by}, MIN({value}) AS min, MIN({value}) FILTER ({inside}) AS lower_whisker, "
        + ", ".join(f"{_round(f'ANY_VALUE({q})', 6)} AS {q}" for q in ("q1", "median", "q3"))
        + f", MAX({value}) FILTER ({inside}) AS upper_whisker, MAX({value}) AS max "
        f"FROM {source} JOIN ({_quartiles(source, by, value)}) USING ({by}) GROUP BY {by}"
    )


_WITH_NULLS = """
SELECT * REPLACE (CASE WHEN share_of_generation_pct BETWEEN 0 AND 5 THEN NULL ELSE generation_twh END AS generation_twh,
                  CASE WHEN share_of_generation_pct BETWEEN 0 AND 5 THEN NULL ELSE share_of_generation_pct END
                    AS share_of_generation_pct) FROM generation"""
_UNUSUAL = (
    "generation_twh < 0 OR share_of_generation_pct < 0 OR share_of_generation_pct > 100"
)
_MIX = """
SELECT g.date, MAX(share_of_generation_pct) FILTER (series = 'STANDARD') AS clean_share_pct,
       MAX(share_of_generation_pct) FILTER (series = 'LARGE') AS fossil_share_pct,
       ANY_VALUE(i.emissions_intensity_gco2_per_kwh) AS emissions_intensity_gco2_per_kwh
FROM generation g JOIN carbon_intensity i ON g.date = i.date AND i.entity_code = 'N07'
WHERE g.entity_code = 'N07' AND series IN ('STANDARD', 'LARGE') GROUP BY g.date"""
_INTENSITY = "emissions_intensity_gco2_per_kwh"


def _correlations() -> str:
    columns = ("clean_share_pct", "fossil_share_pct", _INTENSITY)
    rows = []
    for a in columns:
        cells = ", ".join(
            f"1.0::DOUBLE AS {b}" if a == b else f"{_round(f'corr(m.{min(a, b)}, m.{max(a, b)})', 6)} AS {b}"
            for b in columns
        )
        rows.append(f"SELECT '{a}' AS variable, {cells} FROM mix m HAVING COUNT(*) >= 3")
    return f"{_prelude()} mix AS ({_MIX}) " + " UNION ALL ".join(rows)


def _plan_state() -> str:
    cuts = {
        "generation": "date < TIMESTAMP '2000-01-01'",
        "demand": "true",
        "emissions": "date < TIMESTAMP '2000-01-01'",
        "carbon_intensity": "false",
        "capacity": "date < TIMESTAMP '2001-06-01'",
    }
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS dataset, CAST(MAX(date) AS DATE) AS latest, "
        f"CAST(MAX(date) FILTER ({cut}) AS DATE) AS last_loaded FROM {name}"
        for name, cut in cuts.items()
    )
    skip = "last_loaded IS NOT NULL AND latest <= last_loaded"
    return (
        f"SELECT dataset, latest, last_loaded, CASE WHEN {skip} THEN 'skip' ELSE 'load' END AS action, "
        f"CASE WHEN {skip} THEN NULL WHEN last_loaded IS NULL THEN DATE '{T.PROJECT_START}-01' "
        f"ELSE CAST(date_trunc('month', last_loaded) + INTERVAL 1 MONTH AS DATE) END AS start_date "
        f"FROM ({rows})"
    )


def _ingestion() -> str:
    last = f"strftime(MAX(date), '%Y-%m-%d') AS last_source_date"
    first = _per_dataset(
        f"SELECT CAST(1 AS BIGINT) AS run, '{{d}}' AS dataset, 'load' AS action, {last} FROM {{d}} "
        f"WHERE date >= {START}"
    )
    second = _per_dataset(
        "SELECT CAST(2 AS BIGINT), '{d}', 'skip', CAST(NULL AS VARCHAR)"
    )
    # the first load plus the backfill of one country from 1995 on
    documents = (
        f"SELECT CAST(3 AS BIGINT), 'demand', 'documents', CAST("
        f"(SELECT COUNT(*) FROM demand WHERE date >= {START}) + "
        f"(SELECT COUNT(*) FROM demand WHERE entity_code = 'N07') AS VARCHAR)"
    )
    return f"{first} UNION ALL {second} UNION ALL {documents}"


MART_NAMES = (
    "generation_demand_summary",
    "energy_mix_transition_summary",
    "emissions_carbon_intensity",
    "installed_solar_wind_capacity",
)


# The marts' columns in order.
MART_COLUMNS = {
    "generation_demand_summary": [
        ("country_name", "string"),
        ("entity_code", "string"),
        ("start_year", "bigint"),
        ("end_year", "bigint"),
        ("first_generation_twh", "double"),
        ("latest_generation_twh", "double"),
        ("generation_change_pct", "double"),
        ("first_demand_twh", "double"),
        ("latest_demand_twh", "double"),
        ("demand_change_pct", "double"),
        ("first_net_imports_twh", "double"),
        ("latest_net_imports_twh", "double"),
    ],
    "energy_mix_transition_summary": [
        ("country_name", "string"),
        ("entity_code", "string"),
        ("start_year", "bigint"),
        ("end_year", "bigint"),
        ("renewable_start_pct", "double"),
        ("renewable_end_pct", "double"),
        ("renewable_change_pp", "double"),
        ("fossil_start_pct", "double"),
        ("fossil_end_pct", "double"),
        ("fossil_change_pp", "double"),
        ("clean_start_pct", "double"),
        ("clean_end_pct", "double"),
        ("clean_change_pp", "double"),
    ],
    "emissions_carbon_intensity": [
        ("start_year", "bigint"),
        ("end_year", "bigint"),
        ("country_name", "string"),
        ("emissions_start_mtco2", "double"),
        ("emissions_end_mtco2", "double"),
        ("emissions_change_pct", "double"),
        ("carbon_intensity_start", "double"),
        ("carbon_intensity_end", "double"),
        ("carbon_intensity_change_gco2_per_kwh", "double"),
    ],
    "installed_solar_wind_capacity": [
        ("start_year", "bigint"),
        ("end_year", "bigint"),
        ("country_name", "string"),
        ("solar_start_gw", "double"),
        ("solar_end_gw", "double"),
        ("solar_change_pct", "double"),
        ("wind_start_gw", "double"),
        ("wind_end_gw", "double"),
        ("wind_change_pct", "double"),
        ("solar_wind_start_gw", "double"),
        ("solar_wind_end_gw", "double"),
        ("solar_wind_change_pct", "double"),
    ],
}


def _mart_schema() -> str:
    """The marts' columns as DuckDB types them, under Spark's type names."""
    kinds = "CASE column_type WHEN 'VARCHAR' THEN 'string' ELSE lower(column_type) END"
    return " UNION ALL ".join(
        f"SELECT '{m}' AS mart, row_number() OVER () - 1 AS position, column_name, {kinds} AS data_type "
        f"FROM (DESCRIBE {_on_marts(f'SELECT * FROM mart_{m}')})"
        for m in MART_NAMES
    )


def _mart_fingerprints() -> str:
    """Rows hashed cell by cell and added up; columns and types as DuckDB sees them."""
    parts = []
    for m in MART_NAMES:
        cells = []
        for name, kind in MART_COLUMNS[m]:
            text = f"CAST({name} AS VARCHAR)"
            if kind == "double":
                decimal = f"CAST(CAST({name} AS VARCHAR) AS DECIMAL(38,10))"
                text = f"regexp_replace(CAST({decimal} AS VARCHAR), '\\.?0+$', '')"
            cells.append(f"COALESCE(length({text}) || ':' || {text}, '-')")
        names = ",".join(f"{name} {kind}" for name, kind in MART_COLUMNS[m])
        sums = ", ".join(f"SUM(('0x' || substr(h, {1 + 16 * i}, 16))::UBIGINT)::HUGEINT AS s{i}" for i in range(4))
        parts.append(
            f"SELECT '{m}' AS mart, rows, sha256(concat_ws('|', '1', '{names}', rows, s0, s1, s2, s3)) AS fingerprint "
            f"FROM (SELECT COUNT(*) AS rows, {sums} FROM (SELECT sha256({' || '.join(cells)}) AS h FROM mart_{m}))"
        )
    return _on_marts(" UNION ALL ".join(parts))


def _marts_union(template: str) -> str:
    return " UNION ALL ".join(template.format(m=name) for name in MART_NAMES)


# The columns of totals that are published with six decimals.
_TOTALS = {
    "annual_generation": ["generation_twh"],
    "annual_demand": ["demand_twh"],
    "annual_domestic_net_imports": ["domestic_generation_twh", "net_imports_twh"],
    "annual_balance": ["domestic_generation_twh", "net_imports_twh", "demand_twh"],
    "annual_mix": ["generation_twh"],
    "annual_mix_months": ["generation_twh"],
    "annual_total": ["total_generation_twh"],
    "monthly_mix": ["generation_twh"],
    "annual_shares": ["generation_twh", "generation_share_pct"],
    "mix_pivot": [f"{c}_{w}_pct" for c in ("renewable", "fossil", "clean") for w in ("start", "end")],
    "annual_emissions": ["emissions_mtco2"],
    "annual_intensity": ["avg_carbon_intensity_gco2_per_kwh"],
    "emissions_pivot": [
        "emissions_start_mtco2", "emissions_end_mtco2", "carbon_intensity_start", "carbon_intensity_end"
    ],
    "annual_capacity": ["avg_capacity_gw"],
    "capacity_pivot": [f"{c}_{w}_gw" for c in ("solar", "wind") for w in ("start", "end")],
}


def _totals(query: str, table: str, without: str = "") -> str:
    columns = ", ".join(f"{_round(c, 6)} AS {c}" for c in _TOTALS[query])
    left = f"EXCLUDE ({without}) " if without else ""
    return f"SELECT * {left}REPLACE ({columns}) FROM {table}"


def oracle() -> dict[str, str]:
    sql = {
        # cleaning
        "silver_clean_generation": _on_datasets(f"SELECT * FROM generation WHERE date >= {START}"),
        "silver_scope_filter": _on_datasets(
            _per_dataset(
                "SELECT '{d}' AS dataset, entity_code, date, COUNT(*) AS kept_rows FROM {d} "
                f"WHERE '{{d}}' = 'capacity' OR date >= {START} GROUP BY entity_code, date"
            )
        ),
        "silver_sorted_demand": _on_datasets("SELECT * FROM demand"),
        "silver_country_scope": f"""
            SELECT dataset, entity_code FROM ({_NATION_CODES}),
              (VALUES {", ".join(f"('{d}')" for d in S.DATASETS)}) AS names(dataset)
            WHERE dataset <> 'capacity' OR n_regionkey <= 1""",
        "backfill_scope": f"""
            SELECT MIN(c_custkey) AS pos, entity_code
            FROM customer JOIN ({_entities("nation")}) ON c_nationkey = n_nationkey
            WHERE n_regionkey <= 1 GROUP BY entity_code""",
        # increments
        "increment_plan": _on_datasets(_plan_state()),
        "increment_slice": _on_datasets(
            f"SELECT * FROM generation WHERE date >= {SPLIT} AND entity_code IN "
            "(SELECT entity_code FROM entities WHERE n_regionkey = 3)"
        ),
        "state_advance": _on_datasets(
            _per_dataset(
                "SELECT '{d}' AS dataset, CAST(MAX(date) AS DATE) AS last_source_date FROM {d}"
            )
        ),
        "change_plan": f"""
            SELECT path, mtime, length, false AS full_rebuild FROM ({_FILES})
            WHERE path >= 'ship/2000-07.json'""",
        "full_rebuild_plan": f"SELECT path, mtime, length, true AS full_rebuild FROM ({_FILES})",
        "content_change_plan": f"""
            WITH f AS (SELECT * FROM ({_FILES}) JOIN (
              SELECT 'ship/' || strftime(l_shipdate, '%Y-%m') || '.json' AS path, CAST(SUM(l_orderkey) AS VARCHAR) AS tag
              FROM lineitem GROUP BY 1) USING (path))
            SELECT path, mtime, length, tag, false AS full_rebuild, 'same' AS case FROM f WHERE path >= 'ship/2000-07.json'
            UNION ALL SELECT path, mtime, length, tag, true, 'edited' FROM f""",
        "latest_object": f"SELECT path FROM ({_FILES}) ORDER BY mtime DESC, path DESC LIMIT 1",
        "silver_union_increments": _on_datasets(
            "SELECT entity_code, date, series, generation_twh, source_rank, path, pos "
            f"FROM ({_LOADS})"
        ),
        "silver_merge_generation": _MERGED,
        "silver_merge_idempotent": _MERGED,
        "silver_merge_keep_last": """
            SELECT * FROM lineitem QUALIFY row_number() OVER (
              PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC,
              l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC,
              l_returnflag DESC, l_linestatus DESC) = 1""",
        # raw documents and jobs
        "bronze_inventory": _on_datasets(
            "SELECT load, rows, 0::BIGINT AS wrong_lengths, CASE load WHEN 'first' THEN 1 ELSE 2 END::BIGINT "
            f"AS place FROM (SELECT CASE WHEN date < {SPLIT} THEN 'first' ELSE 'second' END AS load, "
            "COUNT(*) AS rows FROM generation GROUP BY 1)"
        ),
        "bronze_extra_columns": _on_datasets(
            "SELECT entity_code, date, series, upper(series) AS note FROM generation"
        ),
        "source_date_texts": """
            SELECT l_returnflag, l_returnflag <> 'R' AS accepted,
                   CASE WHEN l_returnflag <> 'R' THEN CAST(l_shipdate AS DATE) END AS date, COUNT(*) AS n
            FROM lineitem GROUP BY ALL""",
        "dataset_names": (
            "SELECT lower(r_name) AS name, false AS accepted FROM region UNION ALL "
            f"SELECT name, true FROM (VALUES {', '.join(f'({d!r})' for d in S.DATASETS)}) AS d(name)"
        ),
        "bronze_roundtrip": _on_datasets(f"SELECT * FROM generation WHERE date >= {START}"),
        "silver_incremental_job": _TWO_LOADS,
        "silver_stream_job": _TWO_LOADS,
        "ingestion_job": _on_datasets(_ingestion()),
        # quality
        "dq_missing_columns": _on_datasets(
            "SELECT 'demand' AS table_name, 'missing_column' AS check_name, "
            "'demand_twh' AS column_name, CAST(1 AS BIGINT) AS value, false AS passed UNION ALL "
            f"SELECT {_metric('demand', 'row_count', None, 'COUNT(*)')} FROM demand"
        ),
        "dq_duplicate_excess": f"SELECT CAST(SUM(n - 1) AS BIGINT) AS duplicate_excess FROM ({_KEYS})",
        "dq_duplicate_all_rows": (
            f"SELECT CAST(COALESCE(SUM(n) FILTER (n > 1), 0) AS BIGINT) AS duplicate_rows FROM ({_KEYS})"
        ),
        "dq_duplicate_groups": f"SELECT COUNT(*) FILTER (n > 1) AS duplicate_groups FROM ({_KEYS})",
        "dq_null_counts": " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, COUNT(*) FILTER ({condition}) AS nulls FROM lineitem"
            for c, condition in (
                ("l_orderkey", "l_orderkey IS NULL"),
                ("l_discount", "l_discount = 0 OR l_discount IS NULL"),
                ("l_tax", "l_tax = 0 OR l_tax IS NULL"),
                ("l_returnflag", "l_returnflag IS NULL"),
            )
        ),
        "dq_unexpected_countries": _on_datasets(
            "SELECT DISTINCT entity_code FROM generation WHERE entity_code NOT IN "
            "(SELECT entity_code FROM entities WHERE n_regionkey <> 4)"
        ),
        "dq_silver_report": _on_datasets(_silver_report()),
        "dq_dimensions": _on_datasets(_dimension_report()),
        "dq_facts": _on_datasets(_fact_report()),
        "dq_foreign_keys": _on_datasets(_foreign_key_report()),
        "dq_gold_verdict": _on_datasets(
            "SELECT bool_and(passed) AS passed, COUNT(*) AS checks, "
            "COUNT(*) FILTER (NOT passed) AS failed FROM ("
            f"{_dimension_report()} UNION ALL {_fact_report()} UNION ALL {_foreign_key_report()})"
        ),
        "dq_persisted_table": _on_datasets(_persisted()),
        "dq_mart_checks": _on_marts(
            _marts_union(
                "SELECT '{m}' AS mart, COUNT(*) AS total_rows, COUNT(*) FILTER (country_name IS NULL "
                "OR start_year IS NULL OR end_year IS NULL) AS invalid_rows, (SELECT COUNT(*) FROM "
                "(SELECT 1 FROM mart_{m} GROUP BY country_name, start_year, end_year "
                "HAVING COUNT(*) > 1)) AS duplicate_groups FROM mart_{m}"
            )
        ),
        "key_coverage": _on_datasets(
            " UNION ALL ".join(
                f"SELECT '{d}' AS dataset, COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT "
                f"{', '.join(S.BUSINESS_KEYS[d])} FROM {d})) AS duplicates, "
                f"COUNT(DISTINCT entity_code) AS countries, MIN(date) AS min_date, "
                f"MAX(date) AS max_date FROM {d}"
                for d in S.DATASETS
            )
        ),
        # dimensions and facts
        "series_keys": (
            "SELECT c_name AS name, CAST('0x' || substr(sha256(c_name), 1, 15) AS BIGINT) AS series_key "
            "FROM customer"
        ),
        "capacity_series_keys": (
            "SELECT s_name AS name, CAST('0x' || substr(sha256('capacity::' || s_name), 1, 15) AS BIGINT) "
            "AS capacity_series_key FROM supplier"
        ),
        # marts
        "annual_generation": _on_marts(_totals("annual_generation", "annual_generation")),
        "annual_demand": _on_marts(_totals("annual_demand", "annual_demand")),
        "generation_demand_yearly": _on_marts(
            f"""SELECT country_name, entity_code, g.year,
              {_round("g.generation_twh", 2)} AS generation_twh,
              {_round("d.demand_twh", 2)} AS demand_twh,
              {_round("(g.generation_twh - d.demand_twh)", 2)} AS generation_demand_balance_twh
            FROM annual_generation g JOIN annual_demand d USING (entity_code, year)
            JOIN dim_country USING (entity_code)"""
        ),
        "reports_by_year": _on_marts(
            f"""SELECT country_name, entity_code, g.year,
              {_round("g.generation_twh", 2)} AS generation_twh,
              {_round("d.demand_twh", 2)} AS demand_twh,
              {_round("(g.generation_twh - d.demand_twh)", 2)} AS generation_demand_balance_twh,
              'fact_generation 1997' AS computed_again
            FROM annual_generation g JOIN annual_demand d USING (entity_code, year)
            JOIN dim_country USING (entity_code)"""
        ),
        "annual_domestic_net_imports": _on_marts(_totals("annual_domestic_net_imports", "annual_domestic")),
        "annual_balance": _on_marts(_totals("annual_balance", "annual_balance")),
        "comparison_sources": _on_marts("SELECT * FROM sources"),
        "comparison_period": _on_marts("SELECT * FROM period"),
        "country_period": _on_marts("SELECT * FROM country_period"),
        "annual_mix": _on_marts(_totals("annual_mix", "annual_mix", "months_available")),
        "annual_mix_months": _on_marts(_totals("annual_mix_months", "annual_mix")),
        "complete_country_years": _on_marts("SELECT * FROM complete_country_years"),
        "annual_total": _on_marts(_totals("annual_total", "annual_total")),
        "monthly_mix": _on_marts(_totals("monthly_mix", "monthly_mix", "year, month_number")),
        "annual_shares": _on_marts(_totals("annual_shares", "annual_shares")),
        "energy_mix_yearly": _on_marts(
            f"""SELECT country_name, entity_code, year, energy_category,
              {_round("s.generation_twh", 2)} AS generation_twh,
              {_round("s.generation_share_pct", 1)} AS generation_share_pct
            FROM annual_shares s JOIN dim_country USING (entity_code)"""
        ),
        "eligible_countries": _on_marts("SELECT * FROM eligible_countries"),
        "mix_pivot": _on_marts(_totals("mix_pivot", "mix_pivot")),
        "annual_emissions": _on_marts(_totals("annual_emissions", "annual_emissions")),
        "annual_intensity": _on_marts(_totals("annual_intensity", "annual_intensity")),
        "emissions_pivot": _on_marts(_totals("emissions_pivot", "emissions_pivot")),
        "annual_capacity": _on_marts(_totals("annual_capacity", "annual_capacity")),
        "capacity_pivot": _on_marts(_totals("capacity_pivot", "capacity_pivot")),
        # publication
        "mart_fingerprint": _mart_fingerprints(),
        "publish_skip_unchanged": _on_marts(
            "SELECT run, mart, rows, run = 2 AS skipped FROM (VALUES (1::BIGINT), (2::BIGINT)) AS r(run), ("
            + _marts_union("SELECT '{m}' AS mart, COUNT(*) AS rows FROM mart_{m}")
            + ")"
        ),
        "publish_gold_roundtrip": _on_datasets(_gold_counts()),
        "publish_rollback": _on_datasets(_gold_counts(f"date < {SPLIT}")),
        "registered_model_query": _on_datasets(
            "SELECT country_name, energy_category, COUNT(*) AS observations FROM fact_generation "
            "JOIN dim_country USING (entity_code) JOIN dim_energy_series USING (series_key) "
            "GROUP BY country_name, energy_category"
        ),
        "registered_model_year": _on_datasets(
            f"SELECT entity_code, COUNT(*) AS observations, {_round('SUM(generation_twh)', 2)} AS generation_twh "
            "FROM fact_generation WHERE year(date) = 1995 GROUP BY entity_code"
        ),
        "mart_schema": _mart_schema(),
        # profiling
        "column_profile": _column_profile(),
        "profile_csv": _column_profile(),
        "dataset_coverage": _on_datasets(
            _per_dataset(
                "SELECT '{d}' AS dataset, COUNT(*) AS row_count, COUNT(DISTINCT entity_code) AS countries, "
                "MIN(date) AS min_date, MAX(date) AS max_date FROM {d}"
            )
        ),
        "describe_measures": _on_datasets(_describe()),
        "unusual_rows_top30": _on_datasets(
            "SELECT entity, entity_code, date, series, is_aggregate_series, generation_twh, "
            f"share_of_generation_pct FROM generation WHERE {_UNUSUAL} "
            "ORDER BY share_of_generation_pct DESC, entity_code, date, series LIMIT 30"
        ),
        "unusual_breakdown": _on_datasets(
            "SELECT series, COUNT(*) AS observations, "
            "COUNT(*) FILTER (generation_twh < 0) AS negative_generation, "
            "COUNT(*) FILTER (share_of_generation_pct < 0) AS negative_share, "
            "COUNT(*) FILTER (share_of_generation_pct > 100) AS share_above_100, "
            "MIN(generation_twh) AS min_generation_twh, MAX(generation_twh) AS max_generation_twh, "
            "MIN(share_of_generation_pct) AS min_share_pct, "
            "MAX(share_of_generation_pct) AS max_share_pct FROM generation GROUP BY series "
            f"HAVING COUNT(*) FILTER ({_UNUSUAL}) > 0"
        ),
        "unusual_breakdown_nan": _on_datasets(
            "SELECT series, COUNT(*) AS observations, "
            "COUNT(*) FILTER (generation_twh < 0) AS negative_generation, "
            "COUNT(*) FILTER (share_of_generation_pct < 0) AS negative_share, "
            "COUNT(*) FILTER (share_of_generation_pct > 100) AS share_above_100, "
            "MIN(generation_twh) AS min_generation_twh, MAX(generation_twh) AS max_generation_twh, "
            "MIN(share_of_generation_pct) AS min_share_pct, "
            f"MAX(share_of_generation_pct) AS max_share_pct FROM ({_WITH_NULLS}) GROUP BY series "
            f"HAVING COUNT(*) FILTER ({_UNUSUAL}) > 0"
        ),
        "iqr_screen_nan": _iqr(
            "(SELECT * REPLACE (CASE WHEN l_tax = 0 THEN NULL ELSE l_extendedprice END AS l_extendedprice) "
            "FROM lineitem)",
            "l_returnflag",
            "l_extendedprice",
        ),
        "boxplot_stats_nan": _on_datasets(
            _boxplot(f"(SELECT * FROM ({_WITH_NULLS}) WHERE {_COMPONENTS})", "series", "generation_twh")
        ),
        "annual_sums_wide_range": _on_marts(
            " UNION ALL ".join(
                f"SELECT '{name}' AS scale, entity_code, year, "
                f"{_round(f'(SUM(generation_twh * {scale}::DOUBLE) / {scale}::DOUBLE)', 4)} AS total "
                "FROM fact_generation JOIN dim_energy_series USING (series_key) JOIN dim_date USING (date) "
                f"WHERE NOT is_aggregate_series AND series_name <> 'Net imports' AND year < {T.AS_OF_YEAR} "
                "GROUP BY entity_code, year HAVING COUNT(DISTINCT month_number) = 12"
                for name, scale in (("small", "1e-12"), ("large", "1e21"))
            )
        ),
        "published_wide_range": _on_marts(
            f"""SELECT 'total' AS kind, entity_code AS name, CAST(g.year AS BIGINT) AS period, units, true AS within
            FROM (SELECT entity_code, year, {_units("generation_twh")} AS units
                  FROM fact_generation JOIN dim_energy_series USING (series_key) JOIN dim_date USING (date)
                  WHERE NOT is_aggregate_series AND series_name <> 'Net imports' AND year < {T.AS_OF_YEAR}
                  GROUP BY entity_code, year HAVING COUNT(DISTINCT month_number) = 12) g
            JOIN annual_demand d USING (entity_code, year)
            UNION ALL
            SELECT 'mean', series, CAST(month(date) AS BIGINT), {_units("generation_twh")}, true
            FROM generation WHERE {_COMPONENTS} GROUP BY series, month(date)"""
        ),
        "series_list": _on_datasets("SELECT DISTINCT series, is_aggregate_series FROM generation"),
        "component_rows": _on_datasets(
            f"SELECT entity_code, date, series, generation_twh FROM generation WHERE {_COMPONENTS}"
        ),
        "iqr_screen": _on_datasets(
            _iqr(f"(SELECT * FROM generation WHERE {_COMPONENTS})", "series", "generation_twh")
        ),
        "iqr_screen_lines": _iqr("lineitem", "l_returnflag", "l_extendedprice"),
        "boxplot_stats": _on_datasets(
            _boxplot(f"(SELECT * FROM generation WHERE {_COMPONENTS})", "series", "generation_twh")
        ),
        "country_series_slice": _on_datasets(
            "SELECT * FROM generation WHERE entity_code = 'N07' AND series IN ('SMALL', 'LARGE')"
        ),
        "capacity_slice": _on_datasets("SELECT * FROM capacity WHERE entity_code = 'N07'"),
        "seasonality": _on_datasets(
            f"SELECT CAST(month(date) AS BIGINT) AS month, series, "
            f"{_round('(' + _avg('g.generation_twh') + ')', 6)} AS generation_twh "
            f"FROM generation g WHERE {_COMPONENTS} GROUP BY month(date), series"
        ),
        "demand_intensity_yearly": _on_datasets(
            f"SELECT CAST(year(d.date) AS BIGINT) AS year, "
            f"{_round('(' + _avg('demand_twh') + ')', 6)} AS avg_monthly_demand_twh, "
            f"{_round('(' + _avg(_INTENSITY) + ')', 6)} AS avg_carbon_intensity "
            "FROM demand d JOIN carbon_intensity i ON d.date = i.date AND i.entity_code = 'N07' "
            "WHERE d.entity_code = 'N07' GROUP BY year(d.date)"
        ),
        "mix_pivot_by_date": _on_datasets(_MIX),
        "mix_intensity_corr": _correlations(),
        "intensity_ols": (
            f"{_prelude()} mix AS ({_MIX}) SELECT COUNT(*) AS n, "
            f"{_round(f'regr_slope({_INTENSITY}, fossil_share_pct)', 6)} AS slope, "
            f"{_round(f'regr_intercept({_INTENSITY}, fossil_share_pct)', 6)} AS intercept, "
            f"{_round(f'regr_r2({_INTENSITY}, fossil_share_pct)', 6)} AS r2 FROM mix "
            "HAVING COUNT(*) >= 3"
        ),
        "country_ranking": _on_datasets(
            f"SELECT entity, entity_code, {_round('(' + _avg(_INTENSITY) + ')', 6)} AS avg_carbon_intensity, "
            "COUNT(DISTINCT date) AS months_observed FROM carbon_intensity "
            "WHERE year(date) = 1999 GROUP BY entity, entity_code"
        ),
        "raw_coverage": (
            "SELECT COUNT(*) AS row_count, CAST(COUNT(*) - COUNT(o_custkey) AS BIGINT) AS null_o_custkey, "
            "CAST(COUNT(*) - COUNT(o_totalprice) AS BIGINT) AS null_o_totalprice, "
            "MIN(o_orderdate) AS min_date, MAX(o_orderdate) AS max_date, "
            "COUNT(DISTINCT o_orderdate) AS unique_dates FROM orders"
        ),
    }
    for table in S.DIMENSION_KEYS:
        sql[table] = _on_datasets(f"SELECT * FROM {table}")
    for table in S.FACT_GRAINS:
        sql[table] = _on_datasets(f"SELECT * FROM {table}")
    for mart in (
        "generation_demand_summary",
        "energy_mix_transition_summary",
        "emissions_carbon_intensity",
        "installed_solar_wind_capacity",
    ):
        sql[f"mart_{mart}"] = _on_marts(f"SELECT * FROM mart_{mart}")
        sql[f"mart_{mart}_by_region"] = _on_marts(f"SELECT * FROM mart_{mart}", "region")
    return sql
