"""tillwise: retail customer analytics as Spark DataFrame operators.

Cleaning and dimensions, RFM scoring and segments, cohort retention,
customer-lifetime-value features and a gradient-boosted forecast, and
market-basket association rules -- each a function from DataFrame to
DataFrame that runs on Spark SQL and Spark ML.
"""

__version__ = "0.1.0"
