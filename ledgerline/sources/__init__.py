"""Sources: declared schemas (``schemas``), file readers (``files``), test-table
adapters (``adapters``) and seeded generators (``synth``).  Import the
sub-modules directly."""
