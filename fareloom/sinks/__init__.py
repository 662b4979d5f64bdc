from fareloom.sinks.tables import ensure_namespace, write_csv, write_jdbc, write_raw, write_star

__all__ = ["ensure_namespace", "write_csv", "write_jdbc", "write_raw", "write_star"]
