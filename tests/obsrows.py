"""Made observations that several tests share."""


def obs_frame(spark, rows, extra_cols=()):
    """A typed observation frame from tuples of
    (station, year, month, day, hour, minute, lat, lon, tmpf, relh, *extra)."""
    from pyspark.sql import types as T

    fields = [T.StructField("station", T.StringType()),
              *[T.StructField(c, T.IntegerType()) for c in ("year", "month", "day", "hour", "minute")],
              T.StructField("lat", T.FloatType()), T.StructField("lon", T.FloatType()),
              T.StructField("tmpf", T.FloatType()), T.StructField("relh", T.FloatType())]
    fields += [T.StructField(n, t) for n, t in extra_cols]
    return spark.createDataFrame(rows, T.StructType(fields))
