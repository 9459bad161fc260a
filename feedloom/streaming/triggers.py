"""When the batches of a stream start."""

from pyspark.sql.streaming import DataStreamWriter


def set_trigger(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """``every`` is the time from batch to batch; None takes what is there and ends."""
    if every is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=every)
