"""Fixed record layouts of the reference's inputs, as Spark schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: record layouts ------------------------------------------
PEOPLE = T.StructType([T.StructField("name", T.StringType()),
                       T.StructField("age", T.LongType())])
EMPLOYEE = T.StructType([T.StructField("name", T.StringType()),
                         T.StructField("salary", T.LongType())])
AD_CLICK = T.StructType([T.StructField("timestamp", T.LongType()),
                         T.StructField("province", T.IntegerType()),
                         T.StructField("city", T.IntegerType()),
                         T.StructField("uid", T.LongType()),
                         T.StructField("adid", T.IntegerType())])
STOCK = T.StructType([T.StructField("ordernumber", T.StringType()),
                      T.StructField("locationid", T.StringType()),
                      T.StructField("dateid", T.StringType())])
STOCK_DETAIL = T.StructType([T.StructField("ordernumber", T.StringType()),
                             T.StructField("rownum", T.IntegerType()),
                             T.StructField("itemid", T.StringType()),
                             T.StructField("number", T.IntegerType()),
                             T.StructField("price", T.DoubleType()),
                             T.StructField("amount", T.DoubleType())])
DATE_DIM = T.StructType([T.StructField(n, T.StringType() if n == "dateid" else T.IntegerType())
                         for n in ("dateid", "years", "theyear", "month", "day", "weekday",
                                   "week", "quarter", "period", "halfmonth")])
RATING = T.StructType([T.StructField("user", T.LongType()),
                       T.StructField("item", T.LongType()),
                       T.StructField("rating", T.DoubleType())])
EDGE = T.StructType([T.StructField("src", T.LongType()), T.StructField("dst", T.LongType()),
                     T.StructField("weight", T.DoubleType())])
VERTEX = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
                       T.StructField("age", T.IntegerType())])
# ---------------------------------------------------------------------------
