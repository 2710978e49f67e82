"""Energy time-series preparation and forecast evaluation as Spark DataFrame operators."""
