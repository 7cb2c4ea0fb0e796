"""DataFrame operators: quality routing, scans, joins, features, SCD2, change feeds."""
