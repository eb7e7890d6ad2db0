"""Hand-made silver and gold frames."""

from __future__ import annotations

import datetime as dt

import pyarrow as pa
from pyspark.sql.pandas.types import to_arrow_type

from almanack import schemas as S
from almanack.operators.facts import gold_model
from almanack.session import run_together
from almanack.sources import lookups


def month(year, number):
    return dt.datetime(year, number, 1)


class Source:
    """Collects rows per dataset and turns them into silver frames."""

    def __init__(self):
        self.rows = {name: [] for name in S.DATASETS}

    def generation(self, code, year, months=range(1, 13), total=None, **series):
        for m in months:
            for name, value in series.items():
                label = name.replace("_", " ")
                row = (f"Land {code}", code, False, month(year, m), label, False, float(value), 10.0)
                self.rows["generation"].append(row)
        return self

    def demand(self, code, year, value, months=range(1, 13)):
        for m in months:
            self.rows["demand"].append((f"Land {code}", code, month(year, m), float(value)))
        return self

    def emissions(self, code, year, value, months=range(1, 13)):
        for m in months:
            self.rows["emissions"].append(
                (f"Land {code}", code, False, month(year, m), "Total generation", True, float(value), 100.0)
            )
        return self

    def intensity(self, code, year, value, months=range(1, 13)):
        for m in months:
            self.rows["carbon_intensity"].append((f"Land {code}", code, month(year, m), float(value)))
        return self

    def capacity(self, code, year, months=range(1, 13), **series):
        for m in months:
            for name, value in series.items():
                self.rows["capacity"].append(
                    (f"Land {code}", code, False, month(year, m), name, name == "Wind", float(value), 1.0)
                )
        return self

    def year(self, code, year, solar=1.0, gas=2.0, flow=0.5, demand=3.0, emitted=4.0,
             intensity=100.0, solar_gw=5.0, wind_gw=6.0, months=range(1, 13)):
        """Every dataset for one country and year."""
        self.generation(code, year, months, Solar=solar, Gas=gas, Net_imports=flow)
        self.demand(code, year, demand, months).emissions(code, year, emitted, months)
        self.intensity(code, year, intensity, months)
        return self.capacity(code, year, months, Solar=solar_gw, Wind=wind_gw)

    def silver(self, spark):
        frames = {}
        for name, rows in self.rows.items():
            schema = S.SILVER_SCHEMAS[name]
            columns = list(zip(*rows)) or [()] * len(schema)
            frames[name] = local(
                spark,
                pa.table(
                    [pa.array(c, to_arrow_type(f.dataType)) for c, f in zip(columns, schema)],
                    schema.fieldNames(),
                ),
                schema,
            )
        return frames

    def gold(self, spark):
        """The model, computed once and kept as local rows."""
        model = gold_model(
            self.silver(spark), lookups.series_classification(spark), lookups.members(spark)
        )
        tables = run_together([model[name].toArrow for name in model], 8)
        return {n: local(spark, t, S.GOLD_SCHEMAS[n]) for n, t in zip(model, tables)}


def local(spark, table, schema):
    return spark.createDataFrame(table, schema)
