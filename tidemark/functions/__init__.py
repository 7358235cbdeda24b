"""Column functions: every one takes and returns Columns and stays inside codegen."""
