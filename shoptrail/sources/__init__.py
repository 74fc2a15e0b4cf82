"""Sources: batch file/table readers, stream readers, and the fixture adapter."""
