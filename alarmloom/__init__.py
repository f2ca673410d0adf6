"""Network-security telemetry as Spark jobs: alarms, vendor alerts, traffic metadata, packets."""
