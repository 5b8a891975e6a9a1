"""UDF: Python models."""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators import windows
from tidemark.operators.models import Context, ModelError, arrow_model, pandas_model, run_model
from tidemark.plans import mart_sql, marts
from tidemark.plans.registry import query, r
from tidemark.sources.tables import Inputs
from tidemark.sources.warehouse import Warehouse


@query(
    "udf_1_python_model",
    f"SELECT event_date, n_events, total_value, value_zscore, true AS bad_result_refused FROM ({mart_sql.ZSCORES})",
)
def python_model(inputs: Inputs) -> DataFrame:
    """A model with a reference, a setting and a stored result; a wrong result is refused."""

    def model(context: Context, spark) -> DataFrame:
        daily = context.ref("daily").select("event_date", "n_events", "total_value")
        return windows.zscores(daily, "total_value", "value_zscore", context.config["places"])

    house = Warehouse.scratch(inputs.spark, "models")
    context = Context({"daily": lambda: marts.daily_events(inputs)}, config={"places": 3}, this="zscores")
    stored = run_model(model, context, inputs.spark, house)
    try:
        run_model(lambda context, spark: [1, 2, 3], context, inputs.spark)
        refused = False
    except ModelError:
        refused = True
    return stored.withColumn("bad_result_refused", F.lit(refused))


@query("udf_2_arrow_model", "SELECT event_id, value, value * 2 AS double_value FROM events")
def arrow_batches(inputs: Inputs) -> DataFrame:
    """A column doubled on Arrow batches inside the executors."""

    def double(batch: pa.Table) -> pa.Table:
        return batch.append_column("double_value", pc.multiply(batch["value"], 2.0))

    events = inputs("events").select("event_id", "value")
    return arrow_model(events, double, "event_id bigint, value double, double_value double")


@query(
    "udf_3_pandas_model",
    f"""SELECT user_id, count(*) AS n_events, max(value) AS top_value, {r("avg(value)", 4)} AS avg_value,
        {r("var_samp(value)", 4)} AS var_value FROM events GROUP BY 1""",
)
def pandas_statistics(inputs: Inputs) -> DataFrame:
    """Statistics per user from pandas partials.

    Each batch is folded to one row per user, and Spark adds the partials up,
    so no task ever holds all rows of a user.
    """

    def partials(rows: pd.DataFrame) -> pd.DataFrame:
        means = rows.groupby("user_id")["value"].transform("mean")
        rows = rows.assign(apart=(rows["value"] - means) ** 2)
        folded = rows.groupby("user_id").agg(
            n=("value", "size"), total=("value", "sum"), apart=("apart", "sum"), top=("value", "max")
        )
        return folded.reset_index()

    schema = "user_id bigint, n bigint, total double, apart double, top double"
    parts = pandas_model(inputs("events").select("user_id", "value"), partials, schema)
    # What lies apart inside the partials, and the partials' means from the user's mean: nothing large cancels.
    # The window and the grouping share one shuffle, and the Python stage runs once.
    user = Window.partitionBy("user_id")
    parts = parts.withColumn("mean", F.sum("total").over(user) / F.sum("n").over(user))
    between = F.sum(F.col("n") * F.pow(F.col("total") / F.col("n") - F.col("mean"), 2))
    n = F.sum("n")
    variance = F.try_divide(F.sum("apart") + between, n - 1)
    return parts.groupBy("user_id").agg(
        n.alias("n_events"),
        F.max("top").alias("top_value"),
        F.round(F.first("mean").cast("decimal(38,10)"), 4).cast("double").alias("avg_value"),
        F.round(variance.cast("decimal(38,10)"), 4).cast("double").alias("var_value"),
    )
