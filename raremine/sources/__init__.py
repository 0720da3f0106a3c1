"""Sources and sinks: driver tables, keyed record sets, text files, model bundles."""
