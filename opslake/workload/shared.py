"""The cluster's shared folder."""

from opslake.sources.scratch import shared_dir

__all__ = ["shared_dir"]
