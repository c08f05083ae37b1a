"""boxstats: statistics of particles and objects in a periodic cube, on Spark DataFrames."""
