"""The stored candle table in the session catalog."""

from candlemill.schemas import CANDLE_COLS, CANDLE_TABLE


def create_table(spark, location, name=CANDLE_TABLE):
    """Creates the table if it is new. Parquet has no keys: ``quality.gate`` checks them."""
    spark.sql(
        f"""
        CREATE TABLE IF NOT EXISTS {name} (
            symbol STRING NOT NULL,
            timestamp TIMESTAMP_NTZ NOT NULL,
            open DOUBLE,
            high DOUBLE,
            low DOUBLE,
            close DOUBLE,
            volume DOUBLE,
            number_of_trades BIGINT
        )
        USING parquet
        PARTITIONED BY (symbol)
        LOCATION '{location}'
        """
    )
    return spark.table(name)


def append_rows(candles, name=CANDLE_TABLE):
    """Adds rows; partition columns come last in a table, so columns go by name."""
    names = candles.sparkSession.table(name).columns
    candles.select(*names).write.mode("append").insertInto(name)


def read_rows(spark, name=CANDLE_TABLE):
    return spark.table(name).select(*CANDLE_COLS)
