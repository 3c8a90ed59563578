"""DataFrame to DataFrame operators. All are lazy; only ``quality.drop_empty_columns`` reads one row of counts."""
