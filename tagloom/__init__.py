"""Customer-profile tagging on Spark: tag rules, statistics, clustering and recommendation as DataFrame operators."""
