"""Transaction sources.

The engine works on one row per invoice *line* with this contract::

    InvoiceNo string, StockCode string, Quantity int,
    InvoiceDate timestamp_ntz, UnitPrice decimal(20,6),
    CustomerID bigint (nullable), Country string

Prices are exact decimals with six places, so that sums are exact and
independent of the order in which partitions are combined. A value that can't
be read, or would lose digits, is a reject: reading fails on it, or
``read_rejects`` lists it; it never becomes a null or another number.
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(20, 6)

TRANSACTION_SCHEMA = T.StructType([
    T.StructField("InvoiceNo", T.StringType(), True),
    T.StructField("StockCode", T.StringType(), True),
    T.StructField("Quantity", T.IntegerType(), True),
    T.StructField("InvoiceDate", T.TimestampNTZType(), True),
    T.StructField("UnitPrice", MONEY, True),
    T.StructField("CustomerID", T.LongType(), True),
    T.StructField("Country", T.StringType(), True),
])

CONTRACT = [f.name for f in TRANSACTION_SCHEMA.fields]

# Date layouts accepted for InvoiceDate in text files
# (ISO as written by the cleaning step, and the month/day/year form of the
# original download).
DATE_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm", "M/d/yyyy H:mm",
                "M/d/yyyy H:mm:ss", "yyyy-MM-dd")


def parse_invoice_date(col: Column) -> Column:
    """Text → timestamp_ntz, trying each known layout (null if none)."""
    return F.coalesce(*[F.try_to_timestamp(col, F.lit(fmt)).cast("timestamp_ntz")
                        for fmt in DATE_FORMATS])


def _whole(col: Column) -> Column:
    """Text of a whole number (also written as 6.0) → bigint, else null."""
    d = col.try_cast("decimal(38,6)")
    return F.when(d == F.floor(d), d.try_cast("bigint"))


def _price(col: Column) -> Column:
    """Text → price, null if it has more than six places."""
    exact = col.try_cast("decimal(38,18)")
    price = exact.try_cast(MONEY)
    return F.when(price.cast("decimal(38,18)") == exact, price)


def parse_lines(raw: DataFrame) -> DataFrame:
    """All-text invoice lines → the contract's columns plus ``reject``: the
    columns whose text can't be read (null if none). A missing customer is
    allowed, an empty quantity, date or price is not."""
    missing = [c for c in CONTRACT if c not in raw.columns]
    if missing:
        raise ValueError(f"columns missing in the input: {missing}")
    text = {c: F.when(F.trim(F.col(c)) != "", F.trim(F.col(c))) for c in CONTRACT}
    parsed = {
        "InvoiceNo": F.col("InvoiceNo"), "StockCode": F.col("StockCode"), "Country": F.col("Country"),
        "Quantity": _whole(text["Quantity"]).try_cast("int"),
        "InvoiceDate": parse_invoice_date(text["InvoiceDate"]),
        "UnitPrice": _price(text["UnitPrice"]),
        "CustomerID": _whole(text["CustomerID"]),
    }
    bad = [F.when(parsed[c].isNull(), F.lit(c)) for c in ("Quantity", "InvoiceDate", "UnitPrice")]
    bad.append(F.when(parsed["CustomerID"].isNull() & text["CustomerID"].isNotNull(), F.lit("CustomerID")))
    reject = F.concat_ws(",", *bad)
    return raw.select(*[parsed[c].alias(c) for c in CONTRACT], F.when(reject != "", reject).alias("reject"),
                      F.to_json(F.struct(*CONTRACT)).alias("line"))


def _conform(df: DataFrame) -> DataFrame:
    """Typed lines → the contract's types, with ``reject`` as in ``parse_lines``.
    A binary floating point price stands for the nearest price of six places."""
    price = F.col("UnitPrice")
    exact = price.try_cast(MONEY)
    if isinstance(df.schema["UnitPrice"].dataType, (T.DoubleType, T.FloatType)):
        kept = F.abs(exact.cast("double") - price) <= F.greatest(F.abs(price), F.lit(1.0)) * F.lit(1e-9)
    else:
        kept = exact.cast("decimal(38,18)") == price.try_cast("decimal(38,18)")
    parsed = {
        "InvoiceNo": F.col("InvoiceNo").cast("string"), "StockCode": F.col("StockCode").cast("string"),
        "Country": F.col("Country").cast("string"), "Quantity": F.col("Quantity").try_cast("int"),
        "InvoiceDate": F.col("InvoiceDate").try_cast("timestamp_ntz"), "UnitPrice": F.when(kept, exact),
        "CustomerID": F.col("CustomerID").try_cast("bigint"),
    }
    same = {c: parsed[c].isNotNull() & (parsed[c].cast("double") == F.col(c).cast("double")) for c in ("Quantity", "CustomerID")}
    bad = [F.when(~F.coalesce(same["Quantity"], F.lit(False)), F.lit("Quantity")),
           *[F.when(parsed[c].isNull(), F.lit(c)) for c in ("InvoiceDate", "UnitPrice")],
           F.when(F.col("CustomerID").isNotNull() & ~F.coalesce(same["CustomerID"], F.lit(False)), F.lit("CustomerID"))]
    reject = F.concat_ws(",", *bad)
    return df.select(*[parsed[c].alias(c) for c in CONTRACT], F.when(reject != "", reject).alias("reject"),
                     F.to_json(F.struct(*CONTRACT)).alias("line"))


def read_lines(spark: SparkSession, path: str, fmt: str = "csv",
               encoding: str = "ISO-8859-1", multi_line: bool = False) -> DataFrame:
    """Invoice lines with ``reject`` and ``line`` (the input as JSON).

    ``fmt='csv'`` reads the raw or cleaned retail text file: columns are found
    by their header, further ones are ignored, quotes inside quoted text are
    doubled; ``multi_line`` allows line breaks inside it. Any other format
    (``parquet``, ``orc``) carries the contract's columns with types."""
    if fmt == "csv":
        raw = (spark.read.option("header", True).option("encoding", encoding).option("quote", '"')
               .option("escape", '"').option("multiLine", multi_line).option("mode", "FAILFAST").csv(path))
        return parse_lines(raw)
    return _conform(spark.read.format(fmt).load(path))


def read_transactions(spark: SparkSession, path: str, fmt: str = "csv", encoding: str = "ISO-8859-1",
                      multi_line: bool = False, on_reject: str = "fail") -> DataFrame:
    """The contract's columns of ``read_lines``. ``on_reject='fail'`` raises at
    the first line that can't be read; ``'skip'`` leaves such lines to
    ``read_rejects``."""
    lines = read_lines(spark, path, fmt, encoding, multi_line)
    if on_reject == "skip":
        return lines.where("reject is null").select(*CONTRACT)
    stop = F.raise_error(F.concat(F.lit("unreadable "), F.col("reject"), F.lit(" in "), F.col("line")))
    # a filter, so that every action checks every line, whatever columns it reads
    return lines.where(F.when(F.col("reject").isNull(), F.lit(True)).otherwise(stop.cast("boolean"))).select(*CONTRACT)


def read_rejects(spark: SparkSession, path: str, fmt: str = "csv", encoding: str = "ISO-8859-1",
                 multi_line: bool = False) -> DataFrame:
    """(reject, line) of the lines that can't be read."""
    return read_lines(spark, path, fmt, encoding, multi_line).where("reject is not null").select("reject", "line")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def transactions_from_orders(spark: SparkSession, sf_dir: str,
                             with_country: bool = True) -> DataFrame:
    """Fixture A: invoice lines from ``lineitem ⋈ orders ⋈ part``.

    InvoiceNo is the order key, prefixed ``C`` (and the quantity negated)
    for returned lines; the unit price is the part's list price; Country
    comes from ``customer ⟕ nation`` and is only joined when asked for, so
    that jobs without a country scope do not pay for the two joins.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_returnflag")
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    returned = F.col("l_returnflag") == F.lit("R")
    key = F.col("o_orderkey").cast("string")
    qty = F.col("l_quantity").cast("int")
    lines = (li.join(orders, li.l_orderkey == orders.o_orderkey)
             .join(part, li.l_partkey == part.p_partkey))
    cols = [
        F.when(returned, F.concat(F.lit("C"), key)).otherwise(key).alias("InvoiceNo"),
        F.col("l_partkey").cast("string").alias("StockCode"),
        F.when(returned, -qty).otherwise(qty).alias("Quantity"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("InvoiceDate"),
        F.col("p_retailprice").cast(MONEY).alias("UnitPrice"),
        F.col("o_custkey").cast("bigint").alias("CustomerID"),
    ]
    if not with_country:
        return lines.select(*cols, F.lit(None).cast("string").alias("Country"))
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    cust_country = (customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left")
                    .select("c_custkey", "n_name"))
    return (lines.join(cust_country, lines.o_custkey == cust_country.c_custkey, "left")
            .select(*cols, F.col("n_name").alias("Country")))


def transactions_from_events(spark: SparkSession, sf_dir: str,
                             country: str = "ONLINE") -> DataFrame:
    """Fixture B: purchases (and ``error`` events as returns) of ``events``.

    Short history with real times of day, so elapsed-day versus
    calendar-day definitions give different answers here.
    """
    ev = (read_table(spark, sf_dir, "events")
          .select("event_id", "ts", "user_id", "event_type", "value", "props")
          .filter(F.col("event_type").isin("purchase", "error")))
    key = F.col("event_id").cast("string")
    return ev.select(
        F.when(F.col("event_type") == "error", F.concat(F.lit("C"), key))
        .otherwise(key).alias("InvoiceNo"),
        F.col("props").alias("StockCode"),
        F.lit(1).cast("int").alias("Quantity"),
        F.col("ts").cast("timestamp_ntz").alias("InvoiceDate"),
        F.col("value").cast(MONEY).alias("UnitPrice"),
        F.col("user_id").cast("bigint").alias("CustomerID"),
        F.lit(country).alias("Country"),
    )


def edge_transactions(spark: SparkSession) -> DataFrame:
    """Fixture E: hand-made edge rows for unit tests (never registered as a
    query). Each customer exercises one rule of the feature definitions."""
    ts = _dt.datetime
    p = Decimal
    rows = [
        # 1: a single line
        ("1001", "A", 1, ts(2011, 1, 10, 10, 0), p("2.00"), 1, "X"),
        # 2: two lines at the same instant
        ("1002", "A", 1, ts(2011, 2, 1, 9, 0), p("3.00"), 2, "X"),
        ("1002", "B", 2, ts(2011, 2, 1, 9, 0), p("1.50"), 2, "X"),
        # 3: one day, several lines at different times
        ("1003", "A", 1, ts(2011, 3, 1, 8, 0), p("1.00"), 3, "X"),
        ("1004", "B", 1, ts(2011, 3, 1, 12, 0), p("2.00"), 3, "X"),
        ("1005", "C", 1, ts(2011, 3, 1, 18, 0), p("4.00"), 3, "X"),
        # 4: 23:00 then 09:00 the next day (0 elapsed days, 1 calendar day)
        ("1006", "A", 1, ts(2011, 4, 1, 23, 0), p("5.00"), 4, "X"),
        ("1007", "A", 1, ts(2011, 4, 2, 9, 0), p("5.00"), 4, "X"),
        # null customer: dropped
        ("1008", "A", 1, ts(2011, 4, 3, 9, 0), p("5.00"), None, "X"),
        # 'C' inside the invoice number: a return
        ("12C4", "A", 1, ts(2011, 4, 4, 9, 0), p("5.00"), 5, "X"),
        # null invoice: a valid sale
        (None, "A", 1, ts(2011, 4, 5, 9, 0), p("5.00"), 5, "X"),
        ("1009", "B", 1, ts(2011, 5, 5, 9, 0), p("5.00"), 5, "X"),
        # zero price, negative quantity: filtered
        ("1010", "A", 1, ts(2011, 4, 6, 9, 0), p("0.00"), 6, "X"),
        ("1011", "A", -1, ts(2011, 4, 6, 9, 0), p("5.00"), 6, "X"),
        ("1012", "A", 1, ts(2011, 4, 6, 9, 0), p("5.00"), 6, "Y"),
    ]
    # ties in Frequency: seven customers with one invoice each, n mod 5 != 0
    for i in range(7):
        rows.append((f"20{i}", "Z", 1, ts(2011, 6, 1 + i, 12, 0), p("9.99"),
                     100 + i, "Y"))
    return spark.createDataFrame(rows, TRANSACTION_SCHEMA)
