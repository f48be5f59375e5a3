"""Every capability as a query over the driver's tables, with SQL to compare to."""
