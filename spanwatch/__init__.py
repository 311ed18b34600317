"""Business activity monitoring on Spark: pair process events, check KPIs, raise alarms."""
