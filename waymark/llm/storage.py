"""Tables in the folder that the whole cluster shares."""

from waymark.sources.scratch import materialize, shared_dir

__all__ = ["materialize", "shared_dir"]
