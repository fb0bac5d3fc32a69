"""The tables' columns and types. Column names, types and units are fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

BANDS = "ugrizy"

_TYPES = {
    "long": T.LongType(),
    "int": T.IntegerType(),
    "short": T.ShortType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "string": T.StringType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "array<string>": T.ArrayType(T.StringType()),
}


def _table(text: str) -> T.StructType:
    """From lines with a column's name, type and perhaps unit."""
    fields = []
    for line in filter(str.strip, text.splitlines()):
        name, kind, *unit = line.split()
        fields.append(T.StructField(name, _TYPES[kind], True, {"unit": unit[0]} if unit else {}))
    return T.StructType(fields)


_BAND = """
    {b}_nObs int
    {b}_H float mag
    {b}_HErr float mag
    {b}_G12 float
    {b}_G12Err float
    {b}_H_{b}_G12_Cov float
    {b}_nObsUsed int
    {b}_Chi2 float
    {b}_phaseAngleMin float deg
    {b}_phaseAngleMax float deg
    {b}_slope_fit_failed boolean
"""

SS_OBJECT = _table(
    """
    ssObjectId long
    designation string
    nObs int
    arc float d
    firstObservationMjdTai double d
    MOIDEarth float AU
    MOIDEarthDeltaV float km/s
    MOIDEarthEclipticLongitude float deg
    MOIDEarthTrueAnomaly float deg
    MOIDEarthTrueAnomalyObject float deg
    tisserand_J float
    extendednessMax float
    extendednessMedian float
    extendednessMin float
    """
    + "".join(_BAND.format(b=b) for b in BANDS)
)
SS_SOURCE = _table(
    """
    diaSourceId long
    ssObjectId long
    designation string
    eclLambda double deg
    eclBeta double deg
    galLon double deg
    galLat double deg
    elongation float deg
    phaseAngle float deg
    topoRange float AU
    topoRangeRate float km/s
    helioRange float AU
    helioRangeRate float km/s
    ephRa double deg
    ephDec double deg
    ephVmag float mag
    ephRate float deg/d
    ephRateRa float deg/d
    ephRateDec float deg/d
    ephOffset float arcsec
    ephOffsetRa double arcsec
    ephOffsetDec double arcsec
    ephOffsetAlongTrack float arcsec
    ephOffsetCrossTrack float arcsec
    helio_x float AU
    helio_y float AU
    helio_z float AU
    helio_vx float km/s
    helio_vy float km/s
    helio_vz float km/s
    helio_vtot float km/s
    topo_x float AU
    topo_y float AU
    topo_z float AU
    topo_vx float km/s
    topo_vy float km/s
    topo_vz float km/s
    topo_vtot float km/s
    diaDistanceRank short
    """
)
DIA_SOURCE = _table(
    """
    diaSourceId long
    ssObjectId long
    midpointMjdTai double
    ra double
    dec double
    extendedness float
    band string
    psfFlux double
    psfFluxErr double
    """
)
OBS_SBN = _table(
    """
    trksub string
    obssubid long
    provid string
    permid string
    submission_id string
    ra double
    dec double
    obstime timestamp_ntz
    designation_asterisk boolean
    """
)
MPC_ORBITS = _table(
    """
    id int
    designation string
    packed_primary_provisional_designation string
    unpacked_primary_provisional_designation string
    mpc_orb_jsonb string
    created_at timestamp_ntz
    updated_at timestamp_ntz
    orbit_type_int int
    u_param int
    nopp int
    arc_length_total double
    arc_length_sel double
    nobs_total int
    nobs_total_sel int
    a double
    q double
    e double
    i double
    node double
    argperi double
    peri_time double
    yarkovsky double
    srp double
    a1 double
    a2 double
    a3 double
    dt double
    mean_anomaly double
    period double
    mean_motion double
    a_unc double
    q_unc double
    e_unc double
    i_unc double
    node_unc double
    argperi_unc double
    peri_time_unc double
    yarkovsky_unc double
    srp_unc double
    a1_unc double
    a2_unc double
    a3_unc double
    dt_unc double
    mean_anomaly_unc double
    period_unc double
    mean_motion_unc double
    epoch_mjd double
    h double
    g double
    not_normalized_rms double
    normalized_rms double
    earth_moid double
    fitting_datetime timestamp_ntz
    """
)
CURRENT_IDENTIFICATIONS = _table(
    """
    id int
    packed_primary_provisional_designation string
    packed_secondary_provisional_designation string
    unpacked_primary_provisional_designation string
    unpacked_secondary_provisional_designation string
    published boolean
    identifier_ids array<string>
    object_type int
    numbered boolean
    created_at timestamp_ntz
    updated_at timestamp_ntz
    """
)
NUMBERED_IDENTIFICATIONS = _table(
    """
    id int
    packed_primary_provisional_designation string
    unpacked_primary_provisional_designation string
    permid string
    iau_designation string
    iau_name string
    numbered_publication_references array<string>
    named_publication_references array<string>
    naming_credit string
    created_at timestamp_ntz
    updated_at timestamp_ntz
    """
)
TABLES = {
    "SSObject": SS_OBJECT,
    "SSSource": SS_SOURCE,
    "dia_sources": DIA_SOURCE,
    "obs_sbn": OBS_SBN,
    "mpc_orbits": MPC_ORBITS,
    "current_identifications": CURRENT_IDENTIFICATIONS,
    "numbered_identifications": NUMBERED_IDENTIFICATIONS,
}
