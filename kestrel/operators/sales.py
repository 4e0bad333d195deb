"""Star-schema sales: orders joined to order details and a date dimension,
distinct orders and amount per year."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def yearly_sales(stock: DataFrame, detail: DataFrame, dates: DataFrame) -> DataFrame:
    """``SELECT theyear, COUNT(DISTINCT ordernumber), SUM(amount) FROM stock
    JOIN detail USING (ordernumber) JOIN dates USING (dateid) GROUP BY theyear
    ORDER BY theyear`` with the same result, planned for scale:

    * details are summed per order *before* the join (partial aggregation), so
      the join sees one row per order instead of one per line;
    * the date dimension (one row per calendar day) is a plain join, which
      Catalyst and AQE broadcast from its measured bytes;
    * the distinct count is a grouping on (theyear, ordernumber) that reuses
      the join's hash partitioning on ordernumber, so it adds no shuffle.
    """
    per_order = (detail.groupBy("ordernumber")
                 .agg(F.sum("amount").alias("amount")))
    orders = stock.select("ordernumber", "dateid")
    joined = orders.join(per_order, "ordernumber")
    joined = joined.join(dates.select("dateid", "theyear"), "dateid")
    per_year_order = (joined.groupBy("theyear", "ordernumber")
                      .agg(F.sum("amount").alias("amount")))
    return (per_year_order.groupBy("theyear")
            .agg(F.count(F.lit(1)).alias("orders"),
                 F.round(F.sum("amount"), 2).alias("amount"))
            .orderBy("theyear"))
