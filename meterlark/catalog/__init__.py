"""Every operator as a runnable query over the given tables, and the SQL its result must equal."""
