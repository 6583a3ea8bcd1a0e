import datetime as dt

import numpy as np
import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from aeroquarry.functions.frame import POS, with_facts


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    return session


@pytest.fixture
def frame(spark):
    """Observations from lists: (time, lat, lon, {name: value}); times may be seconds after a fixed start."""

    def build(rows, obs="value double", meta="", facts=None, lon_type="double"):
        start = dt.datetime(2021, 7, 31, 22, 44)
        when = lambda t: start + dt.timedelta(seconds=t) if isinstance(t, (int, float)) else t
        data = [(i, when(t), lat, lon, *values) for i, (t, lat, lon, *values) in enumerate(rows)]
        names = [p.split()[0] for p in (meta + ", " + obs if meta else obs).split(", ")]
        schema = f"{POS} long, t timestamp_ntz, lat double, lon {lon_type}, " + (meta + ", " if meta else "") + obs
        df = spark.createDataFrame(data, schema)
        metas = [p.split()[0] for p in meta.split(", ")] if meta else []
        df = df.select(
            POS, F.col(POS).alias("Location"),
            F.struct(F.col("t").alias("dateTime"), F.col("lat").alias("latitude"), F.col("lon").alias("longitude"), *metas).alias("MetaData"),
            F.struct(*[n for n in names if n not in metas]).alias("ObsValue"),
        )
        return with_facts(df, **(facts or {}))

    return build


@pytest.fixture
def rng():
    return np.random.default_rng(11)
