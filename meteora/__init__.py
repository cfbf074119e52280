"""meteora: daily weather-station observations as Spark DataFrame plans.

Long observations (one row per station, day and element) are cleaned,
turned into wide daily and yearly averages, enriched with station and
country dimensions and written as partitioned fact tables.  Every step is a
lazy DataFrame transformation; nothing is collected to the driver.
"""

from meteora.options import CANONICAL, JOB, LOCAL, TransformOptions

__all__ = ["TransformOptions", "CANONICAL", "LOCAL", "JOB"]
