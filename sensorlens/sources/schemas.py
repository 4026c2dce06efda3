"""Fixed schemas, as DDL text."""

TELEMETRY = "timestamp timestamp, tag string, value double"

TAGS = (
    "tag string, tag_description string, category string, threshold_low double, "
    "threshold_high double, threshold_type string, agrregation_rule string, uom string, "
    "legacy_tag_id string, metric string, component string, asset string"
)

ASSETS = (
    "AssetID string, AssetCode string, Category string, AssetType string, Manufacturer string, "
    "Model string, InstallDate string, Location string, OperatingConditions string, "
    "FailureModes string, MaintenanceStrategy string, LastMaintenance string, MTBF_hours int, "
    "Availability_pct double, Latitude double, Longitude double"
)

FEATURES = "tag string, ordinal int, asset string"

MODELS = "asset string, model_uri string, sliding_window int, effective_date timestamp"

ANOMALIES = (
    "asset string, timestamp timestamp, score double, severity double, is_anomaly boolean"
)

INTERPRETATION = (
    "array<struct<tag: string, contribution_score: double, correlation_changes: "
    "struct<changed_variables: array<string>, changed_values: array<double>>>>"
)

VEHICLE_EVENTS = (
    "event_id string, journey_id string, vehicle_id string, driver_id string, timestamp string, "
    "odometer double, lat double, lon double, vehicle_speed double, engine_rpm double, "
    "transmission_gear_position int, gear_lever_position int, accelerator_pedal_position double, "
    "brake_pedal_position double, torque_at_transmission double, engine_temp double, "
    "transmission_temp double, steering_wheel_angle double, door_status string, "
    "ignition_status int, headlamp_status int, high_beam_status int, "
    "windshield_wiper_status int, fuel_level double, parking_brake_status string"
)

# Wire formats: JSON envelopes.
METRIC_ENVELOPE = (
    "metrics array<struct<name: string, timestamp: string, dataType: string, value: double>>"
)

ANOMALY_ENVELOPE = (
    "anomalies array<struct<is_anomaly: bigint, asset: string, timestamp: string, "
    "score: double, severity: double, interpretation: string>>, "
    "EventProcessedUtcTime timestamp, PartitionId bigint, EventEnqueuedUtcTime timestamp"
)

ROUTES = (
    "route_id string, centroid_coordinates array<double>, points array<array<double>>, "
    "total_points int, current_point int"
)
