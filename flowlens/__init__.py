"""flowlens: Spark-native scoring, feature work and evaluation for network-flow tables.

All public functions take and return DataFrames; nothing is collected to the
driver apart from small metadata (feature lists, fitted model handles).
"""

__version__ = "0.1.0"
