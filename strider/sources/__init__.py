"""Sources and sinks: sensor text / CSV files, tables, derived test views."""
