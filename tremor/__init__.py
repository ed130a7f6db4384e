"""tremor: seismic phase picks to earthquake catalogues, expressed as Spark plans."""
