"""netstats: daily statistics over internet speed-test measurements, as Spark jobs."""
