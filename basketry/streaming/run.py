"""How every streaming query of the package is started."""

from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from basketry import settings


def start(writer: DataStreamWriter, checkpoint: str, once: bool) -> StreamingQuery:
    """``once`` works through what is there and stops; otherwise a batch every interval."""
    writer = writer.option("checkpointLocation", checkpoint)
    if once:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=settings.TRIGGER_INTERVAL).start()
