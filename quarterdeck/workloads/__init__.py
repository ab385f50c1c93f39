"""Registered queries: the operators applied to the driver's tables, each beside the SQL it must agree with."""
