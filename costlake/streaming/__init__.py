from costlake.streaming.incremental import refresh_periods, start_incremental_refresh

__all__ = ["refresh_periods", "start_incremental_refresh"]
