"""Configuration files: every setting arrives, none is ignored."""

import json

import pytest
import yaml

from kinelake.operators import episode_filter, quality

JOINTS = """
schema: {embodiment: humanoid, layout: joint_gripper, canonical_dim: 14}
dataset: {root: /data/merged, embodiment: humanoid, robot_type: arm, fps: 30, total_episodes: 46475}
pipeline: {num_workers: 128, output_mode: both, min_episode_length: 30, action_zero_epsilon: 1.0e-4, stage1_post_zero_grace_frames: 60, discard_short_prefix: false}
preprocess: {action_from_state: true}
stage1:
  stats: {recompute: true, cache_path: cache/stage1_global_stats.npz}
  smoothing: {median_kernel: 5, savgol_window: 11, savgol_polyorder: 3}
  thresholds: {k_residual: 60.0, k_accel: 50.0, k_jerk: 40.0, percentile_floor: 99.999}
  hard_limits: {joint_abs_max: 3.5, ee_position_max: 2.5, rpy_abs_max: 3.1, gripper_max: 1.1}
  exclusion:
    mode: validity_mask
    frame_removal: {max_cluster_length: 4, min_cluster_length_for_abnormal: 2}
    episode_discard: {min_cluster_length: 50, min_cluster_frame_jump: 0.25, on_hard_limit_violation: true}
stage2:
  action_type: absolute
  shared_dims: {state_key: observation.state, action_key: action, num_dims: 14}
  smoothing: {median_kernel: 3, savgol_window: 9, savgol_polyorder: 2}
  alignment: {max_lag_frames: 7, diff_epsilon: 1.0e-3, min_active_samples: 12}
  thresholds: {da_per_dim: 0.6, da_episode_mean: 0.7}
  exclusion: {mode: episode_discard}
stage3:
  stats: {recompute: false, cache_path: cache/global_stats.npz, num_histogram_bins: 4096}
  alpha: 0.35
  exempt_dims: {gripper_state: [12, 13], gripper_action: [13], rpy_state: [], rpy_action: []}
  hard_limits: {joint: [-3.4, 3.5], ee_xyz: [-2.0, 2.0], rpy: [-3.15, 3.15], gripper: [-0.01, 1.0]}
  quaternion: {norm_min: 0.95, norm_max: 1.05, component_abs_max: 1.01}
  exclusion: {mode: frame_removal, min_episode_length: 25, validity_mask: prefix_truncate}
stage4: {enabled: true, max_static_steps: 6, change_epsilon: 0.001}
stage5: {enabled: true, reference_frame: camera_top_frame0, rotation_correction_euler_xyz: [0.0, -1.57, 0.0], humanoid_camera_extrinsic_key: camera_front_to_arm_left}
"""


def test_joint_file(tmp_path):
    path = tmp_path / "joints.yaml"
    path.write_text(JOINTS)
    c = quality.QualityConfig.from_yaml(str(path))
    assert c.layout is quality.JOINT and (c.k_residual, c.k_accel, c.k_jerk, c.percentile_floor) == (60, 50, 40, 99.999)
    assert (c.grace_frames, c.min_episode_length, c.stage3_min_length, c.zero_epsilon, c.action_from_state, c.discard_short) == (60, 30, 25, 1e-4, True, False)
    assert (c.joint_abs_max, c.position_max, c.rpy_max, c.gripper_max) == (3.5, 2.5, 3.1, 1.1)
    assert (c.abnormal_cluster, c.episode_cluster, c.cluster_jump, c.discard_on_hard_limit) == (2, 50, 0.25, True)
    assert (c.stage2_median_kernel, c.stage2_savgol_window, c.stage2_savgol_order, c.max_lag, c.diff_epsilon, c.min_active, c.da_dim, c.da_mean) == (3, 9, 2, 7, 1e-3, 12, 0.6, 0.7)
    assert (c.alpha, c.exempt_state, c.exempt_action, c.joint_range, c.bins, c.stats_recompute) == (0.35, (12, 13), (13,), (-3.4, 3.5), 4096, False)
    assert (c.stage4, c.static_steps, c.static_epsilon, c.stage5, c.correction, c.extrinsic_key) == (True, 6, 0.001, True, (0.0, -1.57, 0.0), "camera_front_to_arm_left")
    assert (c.output_mode, c.total_episodes, c.fps) == ("both", 46475, 30)
    assert quality.QualityConfig.from_yaml(str(path), min_episode_length=99, alpha=None).min_episode_length == 99


def test_pose_file_and_defaults():
    given = yaml.safe_load(JOINTS)
    given["schema"] = {"embodiment": "egodex", "layout": "pose_gripper", "canonical_dim": 14, "state_column": "observation.state", "action_column": "action"}
    del given["stage3"]["exempt_dims"]
    given["stage5"] = {"enabled": False, "egodex_extrinsics_column": "observation.camera_extrinsics_world"}
    c = quality.QualityConfig.from_dict(given)
    assert c.layout is quality.POSE and c.exempt_state == c.exempt_action == (3, 4, 5, 6, 10, 11, 12, 13) and not c.stage5


def test_unknown_settings_fail():
    given = yaml.safe_load(JOINTS)
    given["stage1"]["thresholds"]["k_snap"] = 3
    with pytest.raises(ValueError, match="stage1.thresholds.k_snap"):
        quality.QualityConfig.from_dict(given)
    with pytest.raises(ValueError, match="layout"):
        quality.QualityConfig.from_dict({"schema": {"embodiment": "octopus"}})
    with pytest.raises(ValueError, match="nothing"):
        quality.QualityConfig.from_dict({}, nothing=1)


def test_filter_file(tmp_path):
    given = {
        "action_key": "action", "state_key": None, "confidence_key": "observation.confidence", "action_frame": "episode_first_camera", "confidence_min": 0.15, "max_bad_frame_ratio": 0.2,
        "stage1": {"enabled": True, "smooth_window": 11, "median_window": 5, "residual_mean_multiplier": 10.0, "min_threshold": 1e-6},
        "stage2": {"enabled": False, "max_lag": 10, "min_directional_agreement": 0.6, "state_dims": None, "action_dims": None},
        "stage3": {"enabled": True, "lower_percentile": 1.0, "upper_percentile": 99.0, "alpha": 0.2, "exempt_dims": [9, 19]}, "stage5": {"enabled": True, "require_fixed_action_frame": True},
    }
    path = tmp_path / "filter.json"
    path.write_text(json.dumps(given))
    c = episode_filter.FilterConfig.from_json(str(path), confidence_min=0.3)
    assert (c.multiplier, c.alpha, c.exempt, c.lower, c.upper, c.action_frame, c.confidence_min, c.stage2, c.check_frame) == (10.0, 0.2, (9, 19), 0.01, 0.99, "episode_first_camera", 0.3, False, True)
    with pytest.raises(ValueError, match="stage3.beta"):
        episode_filter.FilterConfig.from_dict({"stage3": {"beta": 1}})
