"""adherence: schedule-adherence analytics on Spark.

Load timetables with checks, decode a nested real-time feed, join each stop
update with its scheduled time, keep the latest value per key and serve
queries over the result. Every operator is a function from DataFrames to a
DataFrame, with column names as parameters.
"""

__version__ = "0.1.0"
