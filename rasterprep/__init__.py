"""rasterprep: Spark-native preparation of raster archives as training datasets.

Every public operator is either ``Column -> Column`` (``rasterprep.functions``)
or ``DataFrame -> DataFrame`` (``rasterprep.operators``), usable with
``df.transform``.  Sources and sinks wrap ``spark.read`` / ``df.write``;
``rasterprep.plans`` composes them into the end-to-end jobs.
"""

__version__ = "0.1.0"
