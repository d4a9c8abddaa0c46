"""Sources and sinks: driver tables, the flight fixture, landing files, seeds."""
