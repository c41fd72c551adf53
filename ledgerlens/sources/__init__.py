"""Sources and sinks: the five-table bundle and stored Parquet tables (``tables``), CSV
(``csv``), the load path and derived tables (``etl``), report files (``reports``) and the
adapter from the driver's test tables to the domain tables (``binding``)."""
