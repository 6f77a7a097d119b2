"""Writes to a JDBC candle table. Needs the database's driver on the class path."""

from candlemill.schemas import CANDLE_COLS, CANDLE_TABLE, JDBC_BATCH, KEY, VALUES


def writer_options():
    """Truncating instead of dropping keeps the table's key for later merges."""
    return {
        "truncate": "true",
        "batchsize": str(JDBC_BATCH),
        "createTableColumnTypes": "symbol VARCHAR(20)",
    }


def overwrite_table(candles, url, properties, table=CANDLE_TABLE):
    options = {**writer_options(), **properties}
    candles.select(*CANDLE_COLS).write.jdbc(url, table, mode="overwrite", properties=options)


def merge_statement(staging, table=CANDLE_TABLE, update=True):
    """Statement that folds a staging table written by ``overwrite_table`` into the table."""
    columns = ", ".join(CANDLE_COLS)
    if update:
        action = "DO UPDATE SET " + ", ".join(f"{c} = excluded.{c}" for c in VALUES)
    else:
        action = "DO NOTHING"
    return (
        f"INSERT INTO {table} ({columns}) SELECT {columns} FROM {staging} "
        f"ON CONFLICT ({', '.join(KEY)}) {action}"
    )
