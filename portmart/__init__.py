"""portmart: raw arrivals, temperature, demographics and label files turned into a checked
star schema on Spark, and the mart questions asked of it."""

__version__ = "0.1.0"
