"""rosterforge: a Spark-first engine for harvesting, cleaning and merging rosters of people."""
