"""Plans: the daily run, the driver-table bridge and the registered queries."""
