"""Sources and sinks: typed readers, conformance, the driver-table mapping, publishing."""
