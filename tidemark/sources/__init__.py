"""Sources: Kafka, file stand-ins, lookup dimension, warehouse, given tables."""
