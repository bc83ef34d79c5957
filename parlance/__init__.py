"""parlance: Spark-native analytics for speaker-tagged conversation transcripts.

Every operator is a ``DataFrame -> DataFrame`` function (see ``operators``);
sources and sinks live in ``sources``; column-expression builders in
``functions``; end-to-end compositions and the query catalogue in ``plans``;
incremental ingestion in ``streaming``.
"""

__version__ = "0.1.0"
