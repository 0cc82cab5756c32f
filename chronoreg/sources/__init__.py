"""Sources: the interim snapshot, the state tables and the derived test inputs."""

from chronoreg.sources.tables import State, empty_state, open_rows, read_interim, read_state

__all__ = ["State", "empty_state", "open_rows", "read_interim", "read_state"]
