"""Independent DuckDB SQL oracle for the Spark queries (tests and the driver gate)."""
