"""edgeloom: a Spark-native engine for weighted, directed neuron-to-neuron graphs."""
