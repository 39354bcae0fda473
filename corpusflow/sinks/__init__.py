"""Writers: versioned state (K1), artifact paths (K2), merged markdown (K3), placeholders (K4)."""

from corpusflow.operators.catalogue import artifact_path, sd_card_paths
from corpusflow.sinks.text import write_merged, write_placeholders
from corpusflow.sources.state import save_state

__all__ = ["artifact_path", "sd_card_paths", "save_state", "write_merged", "write_placeholders"]
