"""tripstats -- exact, sampled and sketched group counts on PySpark.

Layers: raw CSV -> bronze Parquet -> silver (cleaned, enriched, year/month
partitioned) -> a uniform sample -> gold comparison tables answering each
group-count question exactly, from the sample and from a Count-Min sketch.
"""

__version__ = "0.1.0"
