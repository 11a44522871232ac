"""Event-stream generation, ingestion and windowed counting on PySpark.

Layers, from the bottom up:

* ``functions``  column expressions (deterministic draws, cell value bytes)
* ``sources``    readers, paced sequences, the schema-driven generator
* ``operators``  DataFrame -> DataFrame transforms, on batch and streaming input
* ``sinks``      tables, windowed files, versioned cells
* ``streaming``  query running, staged arrivals, panes
* ``plans``      configuration and the composed flows
"""
