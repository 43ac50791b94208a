"""tickloom: Spark-native ticker ingestion and analytics.

Raw exchange frames (Kucoin objects, Binance arrays) are decoded, validated and
normalised into one tick schema; ticks are micro-batched, landed in a
partitioned lake, replayed by time range and folded into a current-price
snapshot. Every transform takes and returns a DataFrame, so the same code
serves bounded jobs and Structured Streaming queries.
"""

__version__ = "0.1.0"
