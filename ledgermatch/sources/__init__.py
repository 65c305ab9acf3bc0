"""Sources and sinks: table loaders, fixtures from the test tables, catalogs, files."""
