from tidemark.streaming.pickup import LoadError, catch_up, landed_files, pick_up_new_files

__all__ = ["LoadError", "catch_up", "landed_files", "pick_up_new_files"]
