-- Result tables of the relational store.  query, run and batch_id say which write a row came from.
CREATE TABLE aggregations (
  building VARCHAR(255) NOT NULL, avg_electricity DOUBLE PRECISION, avg_water DOUBLE PRECISION,
  max_elec DOUBLE PRECISION, min_elec DOUBLE PRECISION,
  max_electricity DOUBLE PRECISION, max_water DOUBLE PRECISION,
  window_start TIMESTAMP NOT NULL, window_end TIMESTAMP NOT NULL, processed_at TIMESTAMP,
  query VARCHAR(100) NOT NULL, run VARCHAR(64) NOT NULL, batch_id BIGINT NOT NULL,
  UNIQUE (query, run, batch_id, building, window_start));
CREATE TABLE anomalies (
  building VARCHAR(255) NOT NULL, floor INTEGER, electricity DOUBLE PRECISION, water DOUBLE PRECISION,
  status VARCHAR(20), is_anomaly BOOLEAN, cluster INTEGER, distance DOUBLE PRECISION,
  topic VARCHAR(255), "partition" INTEGER, "offset" BIGINT,
  "timestamp" TIMESTAMP, detected_at TIMESTAMP,
  query VARCHAR(100) NOT NULL, run VARCHAR(64) NOT NULL, batch_id BIGINT NOT NULL,
  UNIQUE (query, run, topic, "partition", "offset"));
CREATE INDEX aggregations_by_time ON aggregations (window_start);
CREATE INDEX anomalies_by_time ON anomalies ("timestamp");
