"""Table jobs: seed from files, and the scheduled chain of gap fill, quality gate and retrain."""

from candlemill.ml import direction
from candlemill.operators.slices import SLICE_BARS
from candlemill.schemas import MINUTE_MS
from candlemill.sources.csvfiles import read_candles
from candlemill.sources.rest import closed_only, decode_pages


def seed(spark, csv_path, store):
    """Commits the historical files to the store; rows it has already stay as they are.

    Rows without a readable time have no key: ``csvfiles.rejected_rows`` lists them. Of rows
    that several files give for one key the least by its values is taken. Returns what was added.
    """
    return store.insert_ignore(read_candles(spark, csv_path))


def fill_gaps(store, pages, now_ms, interval_ms=MINUTE_MS):
    """Commits the closed bars of the landed pages that the store lacks; returns them."""
    return store.insert_ignore(closed_only(decode_pages(pages), now_ms, interval_ms))


def refresh(
    store, pages, now_ms, model_path, interval_ms=MINUTE_MS, slice_bars=SLICE_BARS, **settings
):
    """Runs the steps in order; a failed check raises and nothing is trained or saved.

    What was fetched is committed first and stays, so the next run does not fetch it again.
    """
    fill_gaps(store, pages, now_ms, interval_ms)
    store.gate()
    candles = store.read()
    model = direction.train(candles, interval_ms, slice_bars, **settings)
    direction.save(model, model_path)
    return candles, model
