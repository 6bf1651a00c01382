from landfall.streaming.landing import batch_marker, load_landed_files

__all__ = ["batch_marker", "load_landed_files"]
