from fareloom.streaming.landing import compact_landed, drop_compacted, land_incremental, read_landed

__all__ = ["compact_landed", "drop_compacted", "land_incremental", "read_landed"]
